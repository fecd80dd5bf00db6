"""Spelling variants by variable-length grams.

All grams of two letters up to ``longest`` are counted over the different words. The dictionary keeps a longer gram if the
gram one letter shorter is frequent and it is not too rare itself, so it has at most PRUNED grams a length however many
words there are. A word decomposes into the longest dictionary gram at each position (two letters where there is none),
without grams that lie inside an earlier one.

Whether a gram of a word stays the same depends on the letters up to ``longest`` - 1 places around it, so one inserted,
deleted or replaced letter affects a bounded number of grams; the largest number over all places is the word's
bound. Of any bound + 1 grams of a word one lies, at the same distance from the start or from the end, in each word
that is one edit away. So a word is listed under its bound + 1 rarest grams with both distances. The lists are merged
group by group: a pair needs as many common grams as the bounds leave, and is then verified letter by letter. Every
pair counts in the group of its least common key only. Lists over BLOCK words are cut into cells that meet pairwise.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ledgerloom.llm.common import grouped, key_runs, ship_code, written

SHORTEST_GRAM = 2
# A gram is frequent from a thousandth of all grams on; the dictionary holds none below a 16th of that.
FREQUENT = 1_000
PRUNED = 16_000
# Words on one side of a cell.
BLOCK = 1024
# Pairs looked at together, and the letters and grams of words that fit the matrices; others are compared one by one.
PAIRS = 200_000
WIDTH = 32

SIGNED = "word string, n long, keys array<int>, bits binary, least int"
FOUND = "word string, n_near long, near string, near_n long"


def decompose(word: str, dictionary: set[str], longest: int) -> list[tuple[int, str]]:
    """(start, gram) of a word's variable-length grams."""
    out, last = [], 0
    for p in range(len(word) - SHORTEST_GRAM + 1):
        gram = word[p : p + SHORTEST_GRAM]
        for q in range(longest, SHORTEST_GRAM, -1):
            if p + q <= len(word) and word[p : p + q] in dictionary:
                gram = word[p : p + q]
                break
        if p + len(gram) > last:
            last = p + len(gram)
            out.append((p, gram))
    return out


def affected(length: int, grams: list[tuple[int, str]], longest: int) -> int:
    """The most grams that one edit at any place of a word of ``length`` letters can change."""
    steps = [0] * (length + 2)
    for start, gram in grams:
        steps[max(0, start + len(gram) - longest)] += 1
        steps[min(length, start + longest - 1) + 1] -= 1
    most = now = 0
    for step in steps:
        now += step
        most = max(most, now)
    return most


def _signed(order: dict[str, int], dictionary: set[str], longest: int):
    """Words with the keys of their rarest grams, the places of all grams in a 64-bit map, and the grams an edit leaves."""

    def run(batches):
        for batch in batches:
            keys, bits, least = [], [], []
            for word in batch.column("word").to_pylist():
                grams = decompose(word, dictionary, longest)
                bound = affected(len(word), grams, longest)
                rarest = sorted(grams, key=lambda g: (order.get(g[1], 0), g[1], g[0]))[: bound + 1]
                own = {crc32(f"{g}<{p}".encode()) for p, g in rarest} | {crc32(f"{g}>{len(word) - p}".encode()) for p, g in rarest}
                keys.append(sorted(k - (1 << 31) for k in own))
                bits.append(bytes(crc32(g.encode()) & 63 for _, g in grams))
                least.append(len(grams) - bound)
            arrays = [batch.column("word"), batch.column("n"), pa.array(keys, pa.list_(pa.int32())), pa.array(bits, pa.binary()), pa.array(least, pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, names=["word", "n", "keys", "bits", "least"])

    return run


def one_edit(a: str, b: str) -> bool:
    """Whether two words differ by exactly one inserted, deleted or replaced letter."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[p + (len(a) == len(b)) :] == b[p + 1 :]


def _padded(values: list[np.ndarray], fill: int, kind: type) -> np.ndarray:
    width = max(map(len, values))
    out = np.full((len(values), width), fill, kind)
    out[np.arange(width) < np.array([len(v) for v in values])[:, None]] = np.concatenate(values)
    return out


class _Words:
    """Listed words of some cells as matrices; pairs of them are judged many at a time."""

    def __init__(self, rows: pa.Table):
        self.words = rows["word"].to_pylist()
        self.n = rows["n"].to_numpy()
        self.key = rows["key"].to_numpy()
        self.least = rows["least"].to_numpy()
        self.length = np.array([len(w) for w in self.words])
        self.keys = _padded([np.asarray(k, np.int64) for k in rows["keys"].to_pylist()], 1 << 40, np.int64)
        bits = [np.frombuffer(v[:WIDTH], np.uint8) for v in rows["bits"].to_pylist()]
        self.whole = (self.length <= WIDTH) & (np.array([len(v) for v in bits]) < WIDTH)
        self.bits = _padded(bits, 64, np.uint8)
        single = np.left_shift(np.uint64(1), self.bits.astype(np.uint64) % np.uint64(64))
        self.map = np.bitwise_or.reduce(np.where(self.bits < 64, single, np.uint64(0)), axis=1)
        letters = np.array([w if len(w) <= WIDTH else "" for w in self.words], f"<U{WIDTH}")
        self.letters = letters.view(np.uint32).reshape(len(letters), WIDTH)

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs are one edit apart and have the cell's key as their least common key; a is not the longer one."""
        keep = np.ones(len(a), bool)
        plain = self.whole[a] & self.whole[b]
        # merged lists: grams of a that b may hold, against what both bounds ask for
        common = np.zeros(len(a), np.int32)
        for column in self.bits.T:
            bit = column[a]
            common += (bit < 64) & ((self.map[b] >> (bit.astype(np.uint64) & np.uint64(63))) & np.uint64(1)).astype(bool)
        keep &= ~plain | (common >= np.maximum(self.least[a], self.least[b]))
        at = np.flatnonzero(keep)
        if len(at):
            keep[at] = self._verified(a[at], b[at], plain[at])
        at = np.flatnonzero(keep)
        if len(at):
            own, other = self.keys[a[at]], self.keys[b[at]]
            shared = (own[:, :, None] == other[:, None, :]).any(2) & (own < 1 << 40)
            keep[at] = np.where(shared, own, 1 << 40).min(1) == self.key[a[at]]
        return keep

    def _verified(self, a: np.ndarray, b: np.ndarray, plain: np.ndarray) -> np.ndarray:
        x, y = self.letters[a], self.letters[b]
        apart = x != y
        first = np.where(apart.any(1), apart.argmax(1), WIDTH)
        moved = ((x[:, :-1] != y[:, 1:]) & (np.arange(WIDTH - 1) >= first[:, None])).any(1)
        out = np.where(self.length[a] == self.length[b], apart.sum(1) == 1, ~moved)
        for i in np.flatnonzero(~plain):
            out[i] = one_edit(self.words[a[i]], self.words[b[i]])
        return out


def _pairs(rows: pa.Table, cuts: np.ndarray, length: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of each cell whose lengths differ by at most one, the shorter word first."""
    cell = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    low, high, block = (rows[c].to_numpy() for c in ("low", "high", "block"))
    one, right = low == high, (block != low).astype(np.int64)
    span = int(length.max()) + 3
    place = (2 * cell + right) * span + length
    order = np.argsort(place, kind="stable")
    place, one, right = place[order], one[order], right[order]
    start = np.where(one, np.arange(len(order)) + 1, np.searchsorted(place, place + span - 1, "left"))
    stop = np.where(one, np.searchsorted(place, place + 1, "right"), np.searchsorted(place, place + span + 1, "right"))
    many = np.where(right == 1, 0, np.maximum(stop - start, 0))
    sums = np.concatenate([[0], np.cumsum(many)])
    at = 0
    while at < len(order):
        end = max(at + 1, int(np.searchsorted(sums, sums[at] + PAIRS, "right")) - 1)
        own = many[at:end]
        if own.any():
            left = np.repeat(np.arange(at, end), own)
            other = np.arange(own.sum()) - np.repeat(sums[at:end] - sums[at], own) + np.repeat(start[at:end], own)
            a, b = order[left], order[other]
            swap = length[a] > length[b]
            yield np.where(swap, b, a), np.where(swap, a, b)
        at = end


def _merged(batches):
    """For each word of a cell with near words there: how many, and the one of largest n (ties: the smallest)."""
    for rows, cuts in key_runs(batches, ["key", "low", "high"]):
        sizes = np.diff(cuts)
        if not (sizes > 1).any():
            continue
        keep = np.repeat(sizes > 1, sizes)
        rows, cuts = rows.filter(pa.array(keep)), np.concatenate([[0], np.cumsum(sizes[sizes > 1])])
        held = _Words(rows)
        found = []
        for a, b in _pairs(rows, cuts, held.length):
            near = held.near(a, b)
            if near.any():
                found.append(np.stack([a[near], b[near]]))
        if not found:
            continue
        a, b = np.concatenate(found, axis=1)
        x, y = np.concatenate([a, b]), np.concatenate([b, a])
        rank = np.empty(len(held.words), np.int64)
        rank[sorted(range(len(held.words)), key=held.words.__getitem__)] = np.arange(len(held.words))
        order = np.lexsort((rank[y], -held.n[y], x))
        x, y = x[order], y[order]
        first = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
        counts = np.diff(np.append(first, len(x)))
        words = [held.words[i] for i in x[first]], [held.words[i] for i in y[first]]
        arrays = [pa.array(words[0]), pa.array(counts), pa.array(words[1]), pa.array(held.n[y[first]])]
        yield pa.RecordBatch.from_arrays(arrays, names=["word", "n_near", "near", "near_n"])


def gram_counts(words: DataFrame, longest: int) -> tuple[dict[str, int], set[str]]:
    """Counts of the frequent grams of ``words`` and the dictionary's longer grams: at most PRUNED grams a length."""
    grams = F.flatten(F.transform(
        F.sequence(F.lit(SHORTEST_GRAM), F.lit(longest)),
        lambda q: F.transform(F.sequence(F.lit(1), F.length("word") - q + 1), lambda p: F.substring("word", p, q)),
    ))
    counts = written(words.select(F.explode(grams).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("rows")))
    total = counts.agg(F.sum("rows")).first()[0] or 0
    # at most (longest - 1) * PRUNED rows: each holds that share of all grams of its length or more
    frequent = counts.filter(F.col("rows") * PRUNED >= total)
    order = {gram: rows for gram, rows in frequent.collect()}
    longer = {g for g in order if len(g) > SHORTEST_GRAM and order.get(g[:-1], 0) * FREQUENT >= total}
    return order, longer


def spelling_variants(counts: DataFrame, ratio: int = 5, longest: int = 3) -> DataFrame:
    """For each word the near word it is a variant of: word, form, root, n, n_near, form_n.

    ``counts``: word and n, other columns are ignored; n of repeated words add up, NULL words and NULL n are left out. Near
    words differ by exactly one inserted, deleted or replaced code point. The form is the near word of largest n (ties:
    the smallest in code-point order) if that is ``ratio`` times the word's n or more, else NULL like form_n. The root
    follows forms to the last one and is the word itself where there is none. ``ratio`` must be over 1, so that forms
    end. Words must have 2 * ``longest`` letters: shorter ones could share no gram with a near word. An empty table
    gives an empty one.
    """
    if ratio < 2:
        raise ValueError("forms can run in circles below a ratio of 2")
    spark = counts.sparkSession
    ship_code(spark)
    words = counts.filter("word is not null and n is not null").groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    words = written(words)
    if not words.filter(F.length("word") < 2 * longest).isEmpty():
        raise ValueError(f"words must have {2 * longest} letters or more")
    order, dictionary = gram_counts(words, longest)
    signed = written(words.mapInArrow(_signed(order, dictionary, longest), SIGNED))
    listed = signed.select(F.explode("keys").alias("key"), "word", "n", "keys", "bits", "least")
    sizes = signed.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("words"))
    # one row for BLOCK listed words at most
    large = written(sizes.filter(F.col("words") > BLOCK).select("key", F.ceil(F.col("words") / BLOCK).cast("int").alias("blocks")))
    cells = (
        listed.join(large, "key", "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .select("key", "low", "high", "block", "word", "n", "keys", "bits", "least")
    )
    found = grouped(cells, ["key", "low", "high"]).mapInArrow(_merged, FOUND)
    # of equal n the smallest word: the least pair of negative n and word
    best = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    near_n = -F.col("best.minus")
    known = near_n >= ratio * F.col("n")
    forms = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(known, F.col("best.near")).alias("form"), F.when(known, near_n).alias("form_n")
    )
    forms = written(forms)
    roots = _roots(forms.filter("form is not null").select("word", F.col("form").alias("root")))
    return forms.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.col("n_near").cast("long").alias("n_near"), "form_n"
    )


def _roots(steps: DataFrame) -> DataFrame:
    """Follow (word, root) to the end; every round doubles the steps taken at once."""
    steps = written(steps)
    while True:
        seen = Observation()
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = steps.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next")
        moved = moved.observe(seen, F.count("next").alias("moved"))
        steps = written(moved.select("word", "root"))
        if not seen.get["moved"]:
            return steps
