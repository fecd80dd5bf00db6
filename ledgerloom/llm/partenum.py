"""N-gram Jaccard join by PartEnum signatures.

A text's set holds the hashes of its distinct word shingles. Two sets of a size band whose Jaccard similarity
reaches the threshold differ in at most ``k`` elements. The hash domain is cut into ``n1`` groups, so that some
group holds at most ``k2`` of the differences, and each group into ``n2`` partitions: the elements in some choice
of ``n2 - k2`` partitions of that group are then the same in both sets. Every choice of every group is a
signature; a set has those of its own size band and of the next, so it meets partners of all sizes.

Steps: sets, sizes and sketches of all texts; signatures, gathered by their leading bits; groups of different sets
that share a signature; within a group, pairs whose sketches allow the similarity; exact counts on the whole sets;
components. Equal sets count once from the start. Each set of a group first takes one allowed partner, which
connects copies without listing their pairs. Sets of different components that are still allowed to be similar are
not listed as pairs either: a cell names each such set once, with the smallest component it is tied to there, and
what is tied together is a family. The sets of a family meet in cells of bounded size, where all allowed pairs of
different components are counted exactly and only links that join two components leave. These links connect every component. Whoever asks for all links, or for their number, has the sets of each component
compared with each other: every pair of a component meets in exactly one cell.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import blobs, textbytes
from ledgerloom.llm.common import grouped, key_runs, parts, ship_code, written
from ledgerloom.llm.components import components
from ledgerloom.llm.textbytes import mix

# Cells of the sketch of a set of up to 2048 elements; larger sets have one cell for 16 elements at most.
SKETCH = 128
# Sets of one signature compared with each other in one cell; larger groups become several cells.
BLOCK = 2048
# Shingles of the sets on one side of a cell of a component, on average.
ELEMENTS = 2_000_000
# Pairs a task holds before it lets them go.
FLUSH = 1_000_000

SETS = "doc_id long, digest long, n_shingles long, node long, sketch binary"
GROUPS = "gid long, size long, node long"
PAIRS = "a long, b long"
TIED = "node long, component long, anchor long"
COUNTS = "node long, links long"


def size_bands(threshold: Fraction, most: int = 1 << 40) -> np.ndarray:
    """Smallest size of each band; a partner of a set lies in its own band or one next to it."""
    low, lows = 1, []
    while low < most:
        lows.append(low)
        low = int(Fraction(low) / threshold) + 1
    return np.array(lows)


def shape(threshold: Fraction, largest: int) -> tuple[int, int, int, int]:
    """n1, n2, k2 of a band and how many groups may go without an empty signature.

    With more than k // (k2 + 1) + ``spare`` groups, over ``spare`` groups hold at most k2 differences. Two sets
    that agree on empty choices only have more than ``spare`` groups with an empty choice, and such sets emit
    those, too; all others need not.
    """
    k = int(2 * (1 - threshold) / (1 + threshold) * largest)
    if k == 0:
        return 1, 1, 0, 0
    if k <= 5:
        return 1, k + 3, k, 0
    if k < 24:
        return k // 2 + 2, 3, 1, 1
    spare = 2 + k // 40
    return k + 1 + spare, 1, 0, spare


def signatures(elements: np.ndarray, band: int, form: tuple[int, int, int, int]) -> np.ndarray:
    """Signatures of one sorted set for one band."""
    n1, n2, k2, spare = form
    cells = n1 * n2
    place = ((elements >> np.uint64(32)) * np.uint64(cells)) >> np.uint64(32)
    cuts = np.searchsorted(place, np.arange(cells + 1))
    sums = np.zeros(len(elements) + 1, np.uint64)
    np.cumsum(mix(elements, 3), out=sums[1:])
    value = (sums[cuts[1:]] - sums[cuts[:-1]]).reshape(n1, n2)
    empty = (np.diff(cuts) == 0).reshape(n1, n2)
    if k2:
        choices = list(combinations(range(n2), n2 - k2))
        part = mix(value + np.arange(1, n2 + 1, dtype=np.uint64))
        value = np.stack([part[:, list(c)].sum(1, dtype=np.uint64) for c in choices], 1)
        empty = np.stack([empty[:, list(c)].all(1) for c in choices], 1)
    keys = mix(value + np.arange(value.size, dtype=np.uint64).reshape(value.shape), band + 11)
    if empty.any(1).sum() > spare:
        return keys.ravel()
    return keys[~empty]


def text_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted shingle set of each text."""
    for _, data, offsets in textbytes.slices(texts):
        starts, ends, word_offsets = textbytes.words(data, offsets)
        values, cuts = textbytes.shingles(textbytes.word_hashes(data, starts, ends), word_offsets, k)
        for i in range(len(offsets) - 1):
            yield np.unique(values[cuts[i] : cuts[i + 1]])


def node_of(elements: np.ndarray) -> int:
    """64-bit name of a set."""
    total = mix(elements, 7).sum(dtype=np.uint64) + np.uint64(len(elements))
    return int(mix(np.array([total]), 8).view(np.int64)[0])


def sketch_of(elements: np.ndarray) -> bytes:
    """Elements counted in cells of the hash domain, more cells for larger sets.

    The summed differences of two sketches never exceed those of the sets. Neighbouring cells of a longer sketch add
    up to those of a shorter one.
    """
    cells = min(max(SKETCH, 1 << (max(len(elements) // 16, 1) - 1).bit_length()), 1 << 15)
    place = mix(elements, 5) >> np.uint64(64 - cells.bit_length() + 1)
    return np.minimum(np.bincount(place.astype(np.int64), minlength=cells), 255).astype(np.uint8).tobytes()


def folded(sketches: list[bytes]) -> np.ndarray:
    """Sketches as rows of one matrix, all as short as the shortest."""
    width = min(map(len, sketches))
    return np.stack([np.frombuffer(x, np.uint8).reshape(width, -1).sum(1, dtype=np.int32) for x in sketches])


def _sets(k: int):
    def run(batches):
        for batch in batches:
            n, nodes, sketches = [], [], []
            for elements in text_sets(batch.column("text"), k):
                n.append(len(elements))
                nodes.append(node_of(elements))
                sketches.append(sketch_of(elements) if len(elements) else b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("digest"), pa.array(n, pa.int64()), pa.array(nodes, pa.int64()), pa.array(sketches, pa.binary())],
                names=["doc_id", "digest", "n_shingles", "node", "sketch"],
            )

    return run


def _blobs(k: int, threshold: Fraction, buckets: int):
    """Signatures of a partition's different sets."""

    def run(batches):
        lows = size_bands(threshold)
        forms = [shape(threshold, int(high) - 1) for high in lows[1:]]
        seen: set[int] = set()
        writer = blobs.Writer(buckets)
        for batch in batches:
            for elements in text_sets(batch.column("text"), k):
                node = node_of(elements)
                if len(elements) and node not in seen:
                    seen.add(node)
                    band = int(np.searchsorted(lows, len(elements), "right")) - 1
                    yield from writer.add(node, np.concatenate([signatures(elements, b, forms[b]) for b in (band, band + 1)]))
        yield from writer.close()

    return run


def _shared(batches):
    """Of each bucket, the different groups of two or more nodes that share a signature."""
    for names, owner, starts in blobs.read(batches):
        sizes = np.diff(np.append(starts, len(owner)))
        sums = np.add.reduceat(mix(names[owner].view(np.uint64), 13), starts)
        gid = mix(sums + sizes.astype(np.uint64), 14).view(np.int64)
        starts, sizes, gid = starts[sizes > 1], sizes[sizes > 1], gid[sizes > 1]
        gid, first = np.unique(gid, return_index=True)
        starts, sizes = starts[first], sizes[first]
        at = np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
        arrays = [pa.array(np.repeat(gid, sizes)), pa.array(np.repeat(sizes, sizes)), pa.array(names[owner[at]])]
        yield pa.RecordBatch.from_arrays(arrays, names=["gid", "size", "node"])


def _partners(threshold: Fraction):
    """For cells of groups: (places, x, allowed partners of x) by sizes and sketches; in a cell of one block each pair comes once."""
    up, down = threshold.numerator, threshold.denominator

    def cells(rows: pa.Table, cuts: np.ndarray) -> Iterator[tuple[np.ndarray, Iterator[tuple[int, np.ndarray]]]]:
        nodes, n = rows["node"].to_numpy(), rows["n_shingles"].to_numpy()
        side = rows["block"].to_numpy() == rows["low"].to_numpy()
        one = rows["low"].to_numpy() == rows["high"].to_numpy()

        def pairs(at: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
            flat = folded(rows["sketch"].slice(at[0], len(at)).to_pylist())
            left = at if one[at[0]] else at[side[at]]
            right = at if one[at[0]] else at[~side[at]]
            right = right[np.argsort(n[right], kind="stable")]
            for x in left:
                # sizes of possible partners: threshold * n <= m <= n / threshold
                lo = np.searchsorted(n[right], -(-up * n[x] // down))
                hi = np.searchsorted(n[right], down * n[x] // up, "right")
                y = right[lo:hi]
                y = y[nodes[y] > nodes[x]] if one[x] else y
                if len(y):
                    apart = np.abs(flat[y - at[0]] - flat[x - at[0]]).sum(1, dtype=np.int64)
                    # shared >= threshold * union, with shared = (n + m - apart) / 2 at best
                    total = n[y] + n[x]
                    yield int(x), y[down * (total - apart) >= up * (total + apart)]

        for i in range(len(cuts) - 1):
            at = np.arange(cuts[i], cuts[i + 1])
            yield at, pairs(at)

    return cells


class _Different:
    """Rows of a task, each given once as long as they fit."""

    def __init__(self, names: str):
        self.names = [x.split()[0] for x in names.split(", ")]
        self.held: list[np.ndarray] = []

    def add(self, rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append(rows)
        if sum(map(len, self.held)) > FLUSH:
            self.held = [np.unique(np.concatenate(self.held), axis=0)]
            if len(self.held[0]) > FLUSH // 2:
                yield from self.close()

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            rows, self.held = np.unique(np.concatenate(self.held), axis=0), []
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in rows.T], names=self.names)


def _first_partners(threshold: Fraction):
    """Of each cell, one allowed pair a node: the one with the smallest partner."""
    partners = _partners(threshold)

    def run(batches):
        out = _Different(PAIRS)
        for rows, cuts in key_runs(batches, ["gid", "low", "high"]):
            nodes = rows["node"].to_numpy()
            for _, pairs in partners(rows, cuts):
                found = [(nodes[x], nodes[y].min()) for x, y in pairs if len(y)]
                if found:
                    yield from out.add(np.sort(np.array(found, np.int64), axis=1))
        yield from out.close()

    return run


def _join(root: np.ndarray, x: int, others: np.ndarray) -> None:
    """Give the sets with the roots ``others`` and that of ``x`` one root, the smallest."""
    both = np.append(others, root[x])
    root[np.isin(root, both)] = both.min()


def _tied(threshold: Fraction):
    """Of each cell, the nodes with an allowed partner in another component, each with the smallest component tied to it there."""
    partners = _partners(threshold)

    def run(batches):
        out = _Different(TIED)
        for rows, cuts in key_runs(batches, ["gid", "low", "high"]):
            nodes, component = rows["node"].to_numpy(), rows["component"].to_numpy()
            for at, pairs in partners(rows, cuts):
                different, place = np.unique(component[at], return_inverse=True)
                if len(different) == 1:
                    continue
                root, active = np.arange(len(different)), np.zeros(len(at), bool)
                for x, y in pairs:
                    x, y = x - at[0], y - at[0]
                    y = y[place[y] != place[x]]
                    if len(y):
                        active[x] = active[y] = True
                        others = np.unique(root[place[y]])
                        if len(others) > 1 or others[0] != root[place[x]]:
                            _join(root, place[x], others)
                if active.any():
                    yield from out.add(np.stack([nodes[at][active], component[at][active], different[root[place[active]]]], 1))
        yield from out.close()

    return run


def _reach(threshold: Fraction):
    """Pairs whose whole sets reach the threshold."""
    up, down = threshold.numerator, threshold.denominator

    def run(batches):
        for batch in batches:
            left, right = batch.column("left"), batch.column("right")
            keep = []
            for i in range(batch.num_rows):
                x = np.frombuffer(left[i].as_buffer(), np.uint64)
                y = np.frombuffer(right[i].as_buffer(), np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(down * shared >= up * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _whole(k: int):
    def run(batches):
        for batch in batches:
            # ids may repeat with other texts: only the row whose set it is counts
            sets = [x.tobytes() if node_of(x) == node else None for x, node in zip(text_sets(batch.column("text"), k), batch.column("node").to_pylist())]
            rows = pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], names=["node", "elements"])
            yield rows.filter(rows.column("elements").is_valid())

    return run


def _alike(threshold: Fraction, pairs: bool):
    """Of the cells of components, the similar pairs (a, b), or how many rows each node is linked with there."""
    up, down = threshold.numerator, threshold.denominator

    def cell(nodes, weights, sets, left, right, one):
        n = np.array([len(x) for x in sets])
        right = right[np.argsort(n[right], kind="stable")]
        different, ids = np.unique(np.concatenate([sets[i] for i in right]), return_inverse=True)
        starts = np.concatenate([[0], np.cumsum(n[right])])
        marked = np.zeros(len(different) + 1, np.int32)
        counts = np.zeros(len(nodes), np.int64)
        found = []
        for x in left:
            # sizes of possible partners: threshold * n <= m <= n / threshold
            lo = np.searchsorted(n[right], -(-up * n[x] // down))
            hi = np.searchsorted(n[right], down * n[x] // up, "right")
            if lo == hi:
                continue
            at = np.searchsorted(different, sets[x])
            known = at[different[np.minimum(at, len(different) - 1)] == sets[x]]
            marked[known] = 1
            shared = np.add.reduceat(marked[ids[starts[lo] : starts[hi]]], starts[lo:hi] - starts[lo], dtype=np.int64)
            marked[known] = 0
            y = right[lo:hi][down * shared >= up * (n[x] + n[right[lo:hi]] - shared)]
            y = y[nodes[y] > nodes[x]] if one else y
            if len(y):
                counts[x] += weights[y].sum()
                counts[y] += weights[x]
                if pairs:
                    found.append(np.stack([np.minimum(nodes[x], nodes[y]), np.maximum(nodes[x], nodes[y])]))
                    if sum(f.shape[1] for f in found) > FLUSH:
                        yield np.concatenate(found, axis=1)
                        found = []
        if not pairs:
            yield np.stack([nodes[counts > 0], counts[counts > 0]])
        elif found:
            yield np.concatenate(found, axis=1)

    def run(batches):
        names = [f.split()[0] for f in (PAIRS if pairs else COUNTS).split(", ")]
        for rows, cuts in key_runs(batches, ["component", "low", "high"]):
            block, low, high = (rows[c].to_numpy() for c in ("block", "low", "high"))
            for i in range(len(cuts) - 1):
                part = rows.slice(cuts[i], cuts[i + 1] - cuts[i])
                side, one = block[cuts[i] : cuts[i + 1]] == low[cuts[i]], low[cuts[i]] == high[cuts[i]]
                sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in part["elements"]]
                left, right = np.flatnonzero(side), np.flatnonzero(side if one else ~side)
                if len(left) and len(right):
                    for out in cell(part["node"].to_numpy(), part["weight"].to_numpy(), sets, left, right, one):
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=names)

    return run


def _links_of_family(threshold: Fraction):
    """Of the cells of families, similar pairs (a, b) that join two components there: fewer than components."""
    up, down = threshold.numerator, threshold.denominator

    def cell(nodes, component, sets, left, right):
        n = np.array([len(x) for x in sets])
        flat = folded([sketch_of(x) for x in sets])
        right = right[np.argsort(n[right], kind="stable")]
        names, place = np.unique(component, return_inverse=True)
        root = np.arange(len(names))
        for x in left:
            # sizes of possible partners: threshold * n <= m <= n / threshold
            lo = np.searchsorted(n[right], -(-up * n[x] // down))
            hi = np.searchsorted(n[right], down * n[x] // up, "right")
            y = right[lo:hi]
            y = y[root[place[y]] != root[place[x]]]
            if not len(y):
                continue
            total, apart = n[y] + n[x], np.abs(flat[y] - flat[x]).sum(1, dtype=np.int64)
            for z in y[down * (total - apart) >= up * (total + apart)]:
                if root[place[z]] == root[place[x]]:
                    continue
                shared = len(np.intersect1d(sets[x], sets[z], assume_unique=True))
                if down * shared >= up * (n[x] + n[z] - shared):
                    yield nodes[x], nodes[z]
                    _join(root, place[x], root[place[z]][None])

    def run(batches):
        for rows, cuts in key_runs(batches, ["family", "low", "high"]):
            block, low, high = (rows[c].to_numpy() for c in ("block", "low", "high"))
            found = []
            for i in range(len(cuts) - 1):
                part = rows.slice(cuts[i], cuts[i + 1] - cuts[i])
                side, one = block[cuts[i] : cuts[i + 1]] == low[cuts[i]], low[cuts[i]] == high[cuts[i]]
                sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in part["elements"]]
                left, right = np.flatnonzero(side), np.flatnonzero(side if one else ~side)
                if len(left) and len(right):
                    found += cell(part["node"].to_numpy(), part["component"].to_numpy(), sets, left, right)
            if found:
                both = np.sort(np.array(found, np.int64), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

    return run


def _in_cells(sets: DataFrame) -> DataFrame:
    """Sets with their number of ``blocks``, copied to the cells in which every two blocks of a group meet once."""
    return (
        sets.withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .drop("other", "blocks")
    )


def _blocks_of(classes: DataFrame, group: str) -> DataFrame:
    """How many blocks the classes of a group are dealt to: BLOCK classes and ELEMENTS shingles each, on average."""
    sizes = classes.groupBy(group).agg(F.count(F.lit(1)).alias("classes"), F.sum("n").alias("elements")).filter("classes > 1")
    blocks = F.ceil(F.greatest(F.col("classes") / BLOCK, F.col("elements") / ELEMENTS)).cast("int")
    return sizes.select(group, blocks.alias("blocks"))


def _late_links(docs: DataFrame, nodes: DataFrame, labelled: DataFrame, k: int, threshold: Fraction) -> DataFrame:
    """Links between the components of ``labelled`` cells, by exact counts within families."""
    tied = written(grouped(labelled, ["gid", "low", "high"]).mapInArrow(_tied(threshold), TIED).distinct())
    families = components(tied.select(F.col("component").alias("a"), F.col("anchor").alias("b")))
    ends = tied.select("node", "component").distinct().join(families.toDF("of", "family"), F.col("component") == F.col("of"))
    ends = written(ends.join(nodes, "node").select("node", "component", "family", F.col("rep").alias("doc_id"), F.col("n_shingles").alias("n")))
    texts = docs.join(ends.select("node", "doc_id"), "doc_id").select("node", "text")
    sets = texts.mapInArrow(_whole(k), "node long, elements binary").dropDuplicates(["node"])
    wanted = ends.join(_blocks_of(ends, "family"), "family").select("node", "component", "family", "blocks")
    cells = _in_cells(sets.join(wanted, "node")).select("family", "low", "high", "block", "node", "component", "elements")
    return written(grouped(cells, ["family", "low", "high"]).mapInArrow(_links_of_family(threshold), PAIRS).distinct())


def _component_cells(docs: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """The whole sets of each component with several classes, dealt to cells of bounded size."""
    own = rows.filter("doc_id is not null and n_shingles > 0")
    classes = own.groupBy("node").agg(
        F.min(F.struct("doc_id", "digest")).alias("rep"), F.max("n_shingles").alias("n"), F.max("component").alias("component"), F.count(F.lit(1)).alias("weight"),
    )
    wanted = classes.join(_blocks_of(classes, "component"), "component")
    reps = wanted.select("node", F.col("rep.doc_id").alias("doc_id"), F.col("rep.digest").alias("digest"))
    texts = docs.withColumn("digest", text_digest()).join(reps, ["doc_id", "digest"]).select("node", "text")
    sets = texts.mapInArrow(_whole(k), "node long, elements binary").dropDuplicates(["node"])
    cells = _in_cells(sets.join(wanted.select("node", "component", "blocks", "weight"), "node"))
    return grouped(cells.select("component", "low", "high", "block", "node", "weight", "elements"), ["component", "low", "high"])


def _links(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, k: int, threshold: Fraction) -> DataFrame:
    """The ``pairs`` that reach the threshold, by exact counts; sets come from whole texts once more."""
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = written(nodes.join(ends, "node").select("node", F.col("rep").alias("doc_id")))
    texts = docs.join(wanted, "doc_id").select("node", "text")
    sets = texts.mapInArrow(_whole(k), "node long, elements binary")
    sets = written(sets.dropDuplicates(["node"]))
    left = sets.select(F.col("node").alias("a"), F.col("elements").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("elements").alias("right"))
    return written(pairs.join(left, "a").join(right, "b").mapInArrow(_reach(threshold), PAIRS).distinct())


def jaccard_join(docs: DataFrame, k: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Link texts whose sets of ``k``-word shingles have a Jaccard similarity of ``percent`` / 100 or more.

    Returns (rows, links). rows: one for each row of ``docs`` (doc_id, text; other columns are ignored) with
    doc_id, n_shingles and component_id, the smallest doc_id reachable by links. links: pairs (a, b) of doc_ids,
    each the smallest of its class of equal sets, for all classes of similar sets; they are found when they are
    read. NULL or empty texts have no shingles and link with nothing: their component is their own id.
    Repeated rows each get a row. NULL ids stay NULL and never name a component.
    """
    threshold = Fraction(percent, 100)
    rows, nodes, _ = _joined(docs, k, threshold)
    return rows.select("doc_id", "n_shingles", "component_id"), _all_links(docs, rows, nodes, k, threshold)


def jaccard_links(docs: DataFrame, k: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """The rows of ``jaccard_join`` with n_links, and its links.

    n_links: the other rows with an id whose text is similar, equal ones included; NULL for rows without an id.
    """
    threshold = Fraction(percent, 100)
    rows, nodes, _ = _joined(docs, k, threshold)
    cells = _component_cells(_plain(docs), rows, k)
    near = cells.mapInArrow(_alike(threshold, False), COUNTS).groupBy("node").agg(F.sum("links").alias("links"))
    equal = rows.filter("doc_id is not null and n_shingles > 0").groupBy("node").agg((F.count(F.lit(1)) - 1).alias("equal"))
    counts = equal.join(near, "node", "left").select("node", (F.col("equal") + F.coalesce("links", F.lit(0))).alias("n"))
    counted = rows.join(counts.withColumnRenamed("node", "of"), (F.col("node") == F.col("of")) & (F.col("n_shingles") > 0), "left")
    n_links = F.when(F.col("doc_id").isNotNull(), F.coalesce("n", F.lit(0))).alias("n_links")
    return counted.select("doc_id", "n_shingles", "component_id", n_links), _all_links(docs, rows, nodes, k, threshold)


def _all_links(docs: DataFrame, rows: DataFrame, nodes: DataFrame, k: int, threshold: Fraction) -> DataFrame:
    links = _component_cells(_plain(docs), rows, k).mapInArrow(_alike(threshold, True), PAIRS)
    left = nodes.select(F.col("node").alias("a"), F.col("rep").alias("left"))
    right = nodes.select(F.col("node").alias("b"), F.col("rep").alias("right"))
    return links.join(left, "a").join(right, "b").select(F.col("left").alias("a"), F.col("right").alias("b"))


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def one_of_each_component(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The (doc_id, digest) of one row of each component that ``jaccard_join`` finds; digest is ``text_digest()``.

    Of a component the row with the smallest id stays. An id may stand on different texts: each is judged by itself, and
    of a component's different texts with the smallest id the one with the smallest set name and digest stays.
    Texts without shingles all stay, once an id. Rows without an id are not listed.
    """
    rows = _joined(docs, k, Fraction(percent, 100))[0].filter("doc_id is not null")
    linked = rows.filter("n_shingles > 0").groupBy("component").agg(F.min(F.struct("doc_id", "node", "digest")).alias("kept"))
    plain = rows.filter("n_shingles = 0").select("doc_id", "digest")
    return linked.select("kept.doc_id", "kept.digest").union(plain).distinct()


def text_digest() -> F.Column:
    """Tells the texts of one id apart."""
    return F.xxhash64(F.col("text").cast("string"))


def _joined(docs: DataFrame, k: int, threshold: Fraction) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows with the digest, set name (node) and component of their text; the classes (nodes); connecting links of nodes."""
    spark = docs.sparkSession
    ship_code(spark)
    docs = _plain(docs)
    sets = written(docs.withColumn("digest", text_digest()).mapInArrow(_sets(k), SETS))
    full = sets.filter("n_shingles > 0")
    nodes = written(full.filter("doc_id is not null").groupBy("node").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n_shingles")))
    sketches = full.select("node", "doc_id", "sketch").join(nodes, "node").filter("doc_id = rep").dropDuplicates(["node"])
    sketches = written(sketches.select("node", "n_shingles", "sketch"))
    buckets = parts(spark)
    dealt = docs.filter("doc_id is not null").mapInArrow(_blobs(k, threshold, buckets), blobs.BLOBS)
    groups = written(grouped(dealt, ["bucket"]).mapInArrow(_shared, GROUPS).distinct())
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    cells = (
        groups.join(sketches, "node")
        .withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .drop("other", "size")
    )
    first = written(grouped(cells, ["gid", "low", "high"]).mapInArrow(_first_partners(threshold), PAIRS).distinct())
    links = _links(docs, nodes, first, k, threshold)
    labels = components(links)
    labelled = cells.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    late = _late_links(docs, nodes, labelled, k, threshold)
    if not late.isEmpty():
        links = links.union(late)
        labels = components(links)
    named = nodes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    classes = named.join(lowest, "component").select("node", "component", "component_id")
    names = ["doc_id", "digest", "n_shingles", "node", "component", "component_id"]
    plain = sets.filter("n_shingles = 0").withColumn("component", F.lit(None).cast("long")).withColumn("component_id", F.col("doc_id"))
    return full.join(classes, "node", "left").select(names).union(plain.select(names)), nodes, links
