"""Spelling variants against brute force."""

import os
import random
import re
import zlib
from collections import Counter

import pytest

from ledgerloom.llm import spelling
from ledgerloom.llm.queries import op13_variable_grams

SF_DIR = os.environ.get("LEDGERLOOM_SF_DIR", "/root/testdata/sf0.001")


def one_edit(a, b):
    """By the definition: some deletion of the longer word, or one replaced letter, gives the other."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def near_words(counts):
    """Near words by shared deletions, which is another way than grams."""
    at = {}
    for w in counts:
        for key in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            at.setdefault(key, set()).add(w)
    near = {w: set() for w in counts}
    for group in at.values():
        for a in group:
            near[a] |= {b for b in group if b not in near[a] and one_edit(a, b)}
    return near


def brute(counts, ratio=5):
    near, form = near_words(counts), {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= ratio * n:
            form[w] = best
    out = set()
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), counts[form[w]] if w in form else None))
    return out


def rows(df):
    return [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]


def words_of(rng, letters, n, many):
    """Random words with chains of edits, so that near words of every kind exist."""
    out = []
    for _ in range(many):
        word = [rng.choice(letters) for _ in range(rng.randint(6, n))]
        for _ in range(rng.randint(1, 4)):
            out.append("".join(word))
            i = rng.randrange(len(word))
            kind = rng.randrange(3)
            if kind == 0 and len(word) > 6:
                del word[i]
            elif kind == 1:
                word.insert(rng.randrange(len(word) + 1), rng.choice(letters))
            else:
                word[i] = rng.choice(letters)
    return out


@pytest.mark.parametrize("longest", [2, 3, 4])
@pytest.mark.parametrize("letters", ["ab", "abcdefgh"])
def test_an_edit_leaves_a_listed_gram(longest, letters):
    """Each pair one edit apart shares a key, and as many grams as both bounds leave."""
    rng = random.Random(longest)
    sample = ["".join(rng.choice(letters) for _ in range(rng.randint(2 * longest, 14))) for _ in range(300)]
    grams = Counter(w[i : i + q] for w in sample for q in range(2, longest + 1) for i in range(len(w) - q + 1))
    dictionary = {g for g in grams if len(g) > 2 and rng.random() < 0.5}
    for word in sample:
        for i in range(len(word) + 1):
            for other in (word[:i] + rng.choice(letters) + word[i:], word[:i] + rng.choice(letters) + word[i + 1 :], word[:i] + word[i + 1 :]):
                if len(other) < 2 * longest or other == word:
                    continue
                keys, counts, least = [], [], []
                for w in (word, other):
                    own = spelling.decompose(w, dictionary, longest)
                    bound = spelling.affected(len(w), own, longest)
                    rare = sorted(own, key=lambda g: (grams.get(g[1], 0), g[1], g[0]))[: bound + 1]
                    keys.append({(g, p, 0) for p, g in rare} | {(g, len(w) - p, 1) for p, g in rare})
                    counts.append(Counter(g for _, g in own))
                    least.append(len(own) - bound)
                assert keys[0] & keys[1], (word, other)
                assert sum((counts[0] & counts[1]).values()) >= max(least) >= 1, (word, other)


@pytest.mark.parametrize("a, b, near", [
    ("abcdef", "abcdef", False), ("abcdef", "abcdeg", True), ("abcdef", "abcdefg", True), ("abcdef", "xabcdef", True),
    ("aaaaaa", "aaaaaaa", True), ("abcdef", "abdcef", False), ("abcdef", "abcd", False), ("abcdef", "ghijkl", False), ("abcdef", "bcdefa", False),
])
def test_one_edit(a, b, near):
    assert spelling.one_edit(a, b) == spelling.one_edit(b, a) == one_edit(a, b) == near


@pytest.mark.parametrize("block, pairs", [(1024, 200_000), (3, 5)])
def test_variants_equal_brute_force(spark, monkeypatch, block, pairs):
    rng = random.Random(block)
    counts = Counter()
    for w in words_of(rng, "abcdé", 9, 250) + words_of(rng, "ab", 8, 40):
        counts[w] += rng.choice([1, 1, 2, 5, 9, 60])
    monkeypatch.setattr(spelling, "BLOCK", block)
    if pairs != spelling.PAIRS:
        monkeypatch.setattr(spelling, "PAIRS", pairs)
    df = spark.createDataFrame([(w, n, w, 1) for w, n in counts.items()], "word string, n long, form string, key int")
    got = rows(spelling.spelling_variants(df))
    assert len(got) == len(counts) and set(got) == brute(counts)


def test_awkward_words(spark):
    """Very long words, repeated rows, ties, NULLs and an empty table."""
    long = "ab" * 300
    data = [(long, 50), (long + "x", 3), ("y" + long, 2), (None, 7), ("hidden", None), ("kitten", 4), ("kitten", 6), ("mitten", 100), ("bitten", 100),
            ("zzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzz", 1), ("zzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzzz", 9), ("abcdefghij𝄞", 1), ("abcdefghij𝄞𝄞", 5)]
    df = spark.createDataFrame(data, "word string, n long")
    counts = Counter()
    for w, n in data:
        if w and n:
            counts[w] += n
    got = rows(spelling.spelling_variants(df))
    assert set(got) == brute(counts) and ("kitten", "bitten", "bitten", 10, 2, 100) in got
    assert spelling.spelling_variants(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        spelling.spelling_variants(spark.createDataFrame([("short", 1)], "word string, n long"))


def test_dictionary_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(spelling, "PRUNED", 40)
    rng = random.Random(5)
    df = spark.createDataFrame([("".join(rng.choice("abcdefghijklmnop") for _ in range(9)),) for _ in range(400)], "word string")
    order, longer = spelling.gram_counts(df, 3)
    assert len(order) <= 80 and all(order.get(g[:2]) for g in longer)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_query_equals_brute_force(spark):
    counts = Counter()
    for doc_id, text in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 5}
    got = rows(op13_variable_grams(spark, SF_DIR))
    assert len(got) == len(counts) > 100 and set(got) == brute(counts)
