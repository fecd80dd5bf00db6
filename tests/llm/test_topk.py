"""Exact top-k against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import topk


@pytest.mark.parametrize("dim, n", [(1, 3), (17, 40), (64, 900)])
def test_bounds_lose_nothing(dim, n):
    rng = np.random.default_rng(dim)
    vectors = np.floor(rng.normal(0, 40, (n, dim)))
    vectors[n // 2 :: 3] = vectors[0]  # many ties
    ids = rng.permutation(n).astype(np.int64)
    queries, own = vectors[:7], np.arange(n)[:7]
    q, c, s = topk.best(queries, own, np.ascontiguousarray(vectors.T), ids, np.arange(n), 5, np.full(len(queries), -np.inf))
    for i in range(len(queries)):
        scores = sorted(((-float(queries[i] @ vectors[j]), ids[j]) for j in range(n) if j != i))[:5]
        assert [(-v, ids[k]) for k, v in zip(c[q == i], s[q == i])] == [(a, b) for a, b in scores]


def test_awkward_vectors(spark):
    rows = [
        (0, [1.0, 0.5]), (1, [1.0, 0.5]), (2, [1.0, 0.5]), (3, [-1.0, 2.0]), (4, None), (5, [1.0, None]),
        (6, [float("nan"), 1.0]), (7, []), (8, [1.0, 2.0, 3.0]), (None, [9.0, 9.0]), (50, [0.1, 0.1]), (50, [0.1, 0.1]), (3, [-1.0, 2.0]),
        (100, [5.0, 5.0, 5.0]),
    ]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, score string, rank int")
    asked = F.col("vec_id") % 50 == 0
    got = topk.top_k(df, asked, k=3, scale=256.0)
    found = sorted(tuple(r) for r in got.collect())
    dot = lambda a, b: int(sum(np.floor(256 * np.array(a)) * np.floor(256 * np.array(b))))
    # query 0: the rows 1 and 2 tie; both rows 50 are asked, and meet the same
    assert [(r[1], r[2], r[3]) for r in found if r[0] == 0][:2] == [(1, 1, dot([1, .5], [1, .5])), (2, 2, dot([1, .5], [1, .5]))]
    assert [(r[1], r[2]) for r in found if r[0] == 50] == [(1, 0), (1, 0), (2, 1), (2, 1), (3, 2), (3, 2)]
    assert [(r[1], r[2], r[3]) for r in found if r[0] == 100] == [(1, 8, dot([5, 5, 5], [1, 2, 3]))]
    assert topk.top_k(df, F.col("vec_id") < 0).count() == 0
    assert topk.top_k(df.limit(0), asked).count() == 0


@pytest.mark.parametrize("block, held", [(4096, 8), (16, 2)])
def test_rows_of_one_id_are_asked_and_met_one_by_one(spark, monkeypatch, block, held):
    """Repeated ids with other vectors, all ties, parts of few blocks: against brute force over rows."""
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", block)
    monkeypatch.setattr(topk, "HELD", held)
    rng = np.random.default_rng(block)
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(rng.integers(0, 100, 150), rng.integers(-3, 4, (150, 3)) / 8)]
    rows += [(50, [1.0, 0.0, 0.0]), (50, [0.0, 1.0, 0.0])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3), F.col("vec_id") % 25 == 0, k=4)
    grid = np.floor(256 * np.array([v for _, v in rows])).astype(int)
    want = []
    for i, (query, _) in enumerate(rows):
        if query % 25 == 0:
            best = sorted((-int(grid[i] @ grid[j]), rows[j][0], j) for j in range(len(rows)) if j != i)[:4]
            want += [(query, rank, vec, -s) for rank, (s, vec, _) in enumerate(best, 1)]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
