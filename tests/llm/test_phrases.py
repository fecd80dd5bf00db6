"""The positional index against brute force: phrases, proximity, awkward rows, and no Python in the plan."""

import random
import re

import pytest
from llm_rows import documents

from ledgerloom.llm import phrases

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def windows(items, length):
    out = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - length + 1) if w else 0):
            out.setdefault(tuple(w[i : i + length]), set()).add(item)
    return out


def occurrences(docs, items, length):
    found = windows(items, length)
    for doc, text in docs:
        w = words(text)
        yield doc, len(w), [(i, len(x), x, ids) for x, ids in found.items() for i in range(len(w) - len(x) + 1) if tuple(w[i : i + len(x)]) == x]


def brute(docs, items, length):
    out = []
    for doc, n, spans in occurrences(docs, items, length):
        hit = {i + k for i, size, *_ in spans for k in range(size)}
        ids = sorted({str(x) for *_, own in spans for x in own if x is not None})
        out.append((doc, n, len(hit), len(ids), ids))
    return sorted(out, key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_hit", "n_items", "items").collect()), key=repr)


def items_of(spark, items):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, doc_id int, window string")


def corpus(rng, n, vocabulary=12):
    """Few different words, so that windows overlap, repeat and nearly match."""
    return [(i, " ".join(f"W{rng.randrange(vocabulary)}" for _ in range(rng.randrange(60)))) for i in range(n)]


@pytest.mark.parametrize("length, lists", [(4, 2), (2, 3), (10, 1)])
def test_hits_equal_brute_force(spark, length, lists):
    rng = random.Random(length * lists)
    docs = corpus(rng, 60, 5 if length < 10 else 2)
    items = [(i, t) for i, t in corpus(rng, 25, 5 if length < 10 else 2)] + [(99, "w1 w2"), (98, "w0"), (7, "w3 w4 w1"), (97, "w1 never w2 w3 w4")]
    got = phrases.contaminated(documents(spark, docs), items_of(spark, items), length=length, lists=lists)
    assert rows(got) == brute(docs, items, length)


def test_awkward_rows(spark):
    long = "noise " * 30_000 + "alpha beta gamma"
    docs = [
        (1, None), (2, ""), (3, "!!! --"), (4, " Alpha, BETA\tgamma!"), (4, " Alpha, BETA\tgamma!"), (4, "other words of the same id"), (None, "alpha beta gamma"),
        (None, "nothing"), (5, long), (6, "ÀB alpha-beta_gamma Àb"), (7, "alphabeta gamma"), (8, "a\x00b alpha beta"), (9, "àb"), (10, "x alpha beta alpha beta gamma y"),
    ]
    items = [(1, "alpha beta gamma"), (1, "alpha beta gamma"), (2, None), (3, "..."), (None, "beta gamma"), (10, "ÀB"), (9, "a b")]
    got = phrases.contaminated(documents(spark, docs), items_of(spark, items), length=3)
    assert rows(got) == brute(docs, items, 3)
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in got.filter("doc_id = 10").collect()}
    assert spans == {10: [(3, 3), (4, 2)]}
    assert got.count() == len(docs)
    empty = items_of(spark, items).limit(0)
    assert rows(phrases.contaminated(documents(spark, docs), empty)) == brute(docs, [], 10)
    assert phrases.contaminated(documents(spark, docs).limit(0), items_of(spark, items)).count() == 0


def test_phrase_rows(spark):
    docs, items = [(1, "a b c a b"), (2, "b c"), (2, "b c")], [(1, "a b"), (2, "b c"), (3, "A b")]
    got = sorted(tuple(r) for r in phrases.phrase_matches(documents(spark, docs), items_of(spark, items)).collect())
    assert got == [(1, 1, 0, 2), (1, 1, 3, 2), (1, 2, 1, 2), (1, 3, 0, 2), (1, 3, 3, 2), (2, 2, 0, 2)]


@pytest.mark.parametrize("span", [5])
def test_proximity_equals_brute_force(spark, span):
    rng = random.Random(span)
    docs, items = corpus(rng, 30, 9), [(1, "w1 w2 w3"), (2, "w4 w1"), (3, "w5 w5 w6"), (4, "w7"), (5, "w1 never"), (None, "w2 w8")]
    got = set(tuple(r) for r in phrases.proximity_matches(documents(spark, docs), items_of(spark, items), span).collect())
    index = phrases.PhraseIndex(documents(spark, docs), items_of(spark, items), 10, 10)
    pivot = {r.window: r.term for r in index.slots.filter("list = 0").collect()}
    named = {r.window: tuple(r.words) for r in index.windows.collect()}
    ids = {r.window: r.item_id for r in index.items.collect()}
    want = set()
    for window, rare in pivot.items():
        terms = set(named[window])
        for doc, text in docs:
            w = words(text)
            for p in [i for i, x in enumerate(w) if x == rare]:
                places = [(e - s + 1, s) for s in range(max(0, p - span + 1), p + 1) for e in range(p, min(len(w), s + span))
                          if terms <= set(w[s : e + 1]) and w[s] in terms]
                if places:
                    n, start = min(places)
                    want.add((doc, ids[window], start, n))
    assert got == want and want


def test_native(spark):
    """No Python worker in any plan, also not in the written steps."""
    docs, items = [(i, "w1 w2 w3 w4") for i in range(20)], [(1, "w1 w2")]
    index = phrases.PhraseIndex(documents(spark, docs), items_of(spark, items))
    for df in (index.phrases(), phrases._tokens(index.docs), index.near(5) if index.lists >= index.length else index.lengths()):
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    source = open(phrases.__file__, encoding="utf-8").read()
    assert not re.search(r"udf|pandas|mapIn|applyIn|\.rdd|collect\(\)", source)
