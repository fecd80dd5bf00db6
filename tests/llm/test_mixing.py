"""Temperature mixing: exponents, budgets, blocks and awkward rows."""

import math
from collections import Counter

import pytest
from llm_rows import documents
from pyspark.sql import functions as F

from ledgerloom.llm import mixing

SIZES = {"a": 300, "b": 60, "c": 20, None: 10}


def rows():
    return [(1000 * k + i, "some words here", s) for k, (s, n) in enumerate(SIZES.items()) for i in range(n)]


def shares():
    total = sum(SIZES.values())
    return {s: n / total for s, n in SIZES.items()}


def weights(t):
    z = sum(p**t for p in shares().values())
    return {s: p**t / z for s, p in shares().items()}


def entropy(w):
    return -sum(x * math.log(x) for x in w.values())


def test_target_entropy_is_met_and_the_budget_spent(spark):
    got = mixing.mixed(documents(spark, rows()), entropy=0.8, repeats=None, budget=1.0).collect()
    low, high = 0.0, 1.0
    for _ in range(60):
        t = (low + high) / 2
        low, high = (low, t) if entropy(weights(t)) <= 0.8 * math.log(4) else (t, high)
    want = weights(high)
    counts = Counter(r.source for r in got)
    for source, n in SIZES.items():
        # all texts have four tokens here, so documents stand for tokens
        assert abs(counts[source] - want[source] * sum(SIZES.values())) <= 1
        uses = Counter(r.doc_id for r in got if r.source == source)
        assert max(uses.values()) - min([uses[d] for d in uses] if len(uses) == n else [0]) <= 1
    assert all(0 <= r.mix_position <= 1 for r in got)
    assert {(r.doc_id, r.mix_block) for r in got} and len({(r.doc_id, r.mix_block) for r in got}) == len(got)


def test_repetition_limit_and_full_cover(spark):
    got = mixing.mixed(documents(spark, rows()), repeats=2.0, budget=None).collect()
    uses = Counter(r.doc_id for r in got)
    assert set(uses) == {r[0] for r in rows()}  # nothing is lost
    assert all(uses[d] == 1 for d in range(300))
    assert all(uses[3000 + i] == 2 for i in range(10))
    per = {s: c / SIZES[s] for s, c in Counter(r.source for r in got).items()}
    assert per["a"] <= per["b"] <= per["c"] <= per[None] <= 2.0 + 1e-9


def test_positions_interleave_the_sources(spark):
    got = mixing.mixed(documents(spark, rows()), repeats=None, entropy=0.9, budget=1.0)
    means = got.groupBy("source").agg(F.avg("mix_position").alias("m"), F.count("*").alias("n")).collect()
    assert all(abs(r.m - 0.5) < 0.5 / math.sqrt(r.n) + 0.05 for r in means)


def test_awkward_rows(spark):
    awkward = [(1, None, None), (1, None, None), (None, "", "x"), (2, "long " * 20_000, "y"), (3, "", "y"), (3, "", "y")]
    df = documents(spark, awkward)
    got = mixing.mixed(df, repeats=1.0, budget=None)
    assert sorted(map(str, got.select("doc_id", "source").collect())) == sorted(map(str, df.select("doc_id", "source").collect()))
    assert got.columns == [*df.columns, "mix_block", "mix_position"]
    assert mixing.mixed(df.limit(0)).count() == 0
    again = mixing.mixed(got, repeats=1.0, budget=None)
    assert again.columns == got.columns


def test_no_limit_accepts_equal_weights(spark):
    frame = spark.createDataFrame([("a", 0.9), ("b", 0.1)], "mix_source string, p double")
    t, tokens = mixing.exponent(frame, 100.0, 0.1, 0.9, 2, entropy=None, repeats=None, budget=1.0)
    assert t == 0.0 and tokens == 100.0
    t, _ = mixing.exponent(frame, 100.0, 0.1, 0.9, 2, entropy=0.0, repeats=None, budget=1.0)
    assert t == pytest.approx(1.0)


def test_documents_may_have_columns_of_any_name(spark):
    """Every name the mix uses inside, and NULL in all of them, comes out unchanged."""
    names = ["n", "rest", "blocks", "cut", "spent", "p", "key", "range", "n_tokens", "mix_source", "mix_row", "mix_doc", "before", "upto"]
    rows = [(i, f"text {i} of some words", f"s{i % 3}", *[None if i % 2 else f"{name}{i}" for name in names]) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{n} string" for n in names))
    got = mixing.mixed(df, repeats=1.5, budget=None, block="first", position="second")
    assert got.columns == [*df.columns, "first", "second"]
    assert {tuple(r) for r in got.drop("first", "second").collect()} == set(rows)
