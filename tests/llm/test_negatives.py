"""Hard negatives against brute force; the threshold leaves rows unread and loses none."""

import numpy as np
import pytest

from ledgerloom.llm import negatives


def brute(rows, asked, positives=5, many=10, low=30, high=90, scale=256.0):
    """All (anchor, positive, rank, negative, scores) by exact integers; rows: (vec_id, vector, label)."""
    grids = [[int(np.floor(scale * x)) for x in v] for _, v, _ in rows]
    out = []
    for i, (anchor, _, label) in enumerate(rows):
        if not asked(anchor):
            continue
        scored = [(-sum(a * b for a, b in zip(grids[i], grids[j])), rows[j][0], j) for j in range(len(rows)) if j != i and len(grids[j]) == len(grids[i])]
        for minus, positive, _ in sorted(x for x in scored if rows[x[2]][2] == label)[:positives]:
            within = sorted(x for x in scored if rows[x[2]][2] != label and -low * minus <= -100 * x[0] <= -high * minus)
            out += [(anchor, positive, k + 1, vec, -minus, -s) for k, (s, vec, _) in enumerate(within[:many])]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def table(spark, rows, label="long"):
    full = [(i, v, c, "x", 1, 2) for i, v, c in rows]
    return spark.createDataFrame(full, f"vec_id long, embedding array<double>, label {label}, positives string, row int, part int").repartition(3)


@pytest.mark.parametrize("block, held, depths, labels, dim", [
    (4096, 16, (0, 16, 64, 256, 1024), 4, 8), (16, 2, (0, 1, 3), 4, 8), (8, 1, (0, 2), 1, 3), (8, 3, (0,), 12, 20),
])
def test_equals_brute_force(spark, monkeypatch, block, held, depths, labels, dim):
    # the workers fork from this process, but read the module's own numbers: sizes go by the driver
    monkeypatch.setattr(negatives, "BLOCK", block)
    monkeypatch.setattr(negatives, "HELD", held)
    rng = np.random.default_rng(block + dim)
    centres = rng.normal(0, 1, (labels, dim))
    label = rng.integers(0, labels, 300)
    label[:120] = 0  # a hot label
    vectors = centres[label] * 0.5 + rng.normal(0, 0.4, (300, dim))
    vectors[200:220] = vectors[0]  # ties over labels
    vectors[40] = 0
    rows = [(int(i), [float(x) for x in v], int(c)) for i, v, c in zip(rng.permutation(300), vectors, label)]
    got = found(negatives.hard_negatives(table(spark, rows), negatives.F.col("vec_id") % 10 == 0))
    assert got == brute(rows, lambda i: i % 10 == 0) and (got or labels == 1)


@pytest.mark.parametrize("depths", [(0, 1, 3, 10, 40, 100, 200), (0, 5), (0,)])
def test_threshold_stops_early_and_loses_nothing(monkeypatch, depths):
    monkeypatch.setattr(negatives, "DEPTHS", depths)
    rng = np.random.default_rng(1)
    grid = np.floor(rng.normal(0, 5, (400, 4)))
    grid[:30] += 60
    order = np.argsort(grid.T, axis=1, kind="stable").astype(np.uint16).tobytes()
    ids = rng.permutation(400).astype(np.int64)
    raw = {"ids": ids.tobytes(), "rows": ids.tobytes(), "labels": np.zeros(400, np.int64).tobytes(), "kind": "f8", "dim": 4,
           "grid": grid.tobytes(), "lists": order, "windows": np.zeros(401, np.int64).tobytes()}
    block = negatives._Block(raw)
    anchor = np.array([3.0, 1.0, 2.0, 0.0])
    scores = grid @ anchor
    for lows, highs in (([-np.inf], [np.inf]), ([100], [370]), ([10, 300], [50, 10**6])):
        search = negatives.Search(anchor, list(lows), list(highs), 7)
        scored = search.enter(block, block.grid, anchor, np.ones(400, bool), block.thresholds(anchor[None])[0])
        for w, (low, high) in enumerate(zip(lows, highs)):
            want = sorted((-int(s), int(i), int(i)) for s, i in zip(scores, ids) if low <= s <= high)[:7]
            assert search.window(w) == want
        if len(lows) == 1 and len(depths) > 2:
            assert scored < 400


def test_awkward_rows(spark):
    """NULLs, non-finite numbers, zeros, other dimensions, repeated rows and ids, huge components, an empty table."""
    good = [
        (100, [1.0, 0.5], 1), (100, [1.0, 0.5], 1), (100, [0.0, 1.0], 2), (1, [1.0, 0.5], 1), (2, [0.5, 0.25], 2), (2, [0.5, 0.25], 2), (3, [0.6, 0.1], 3),
        (200, [0.0, 0.0], 1), (300, [-1.0, -1.0], 2), (4, [-0.5, -0.2], 3), (400, [1.0, 2.0, 3.0], 1), (5, [1.0, 1.0, 1.0], 2), (6, [2.0, 2.0, 2.0], 1),
        (500, [1e6, 1e6], 7), (7, [1e6, -1.0], 7), (8, [0.4e6, 0.2], 8), (9, [0.4e6, 0.21], 8),
    ]
    bad = [(None, [1.0, 1.0], 1), (600, None, 1), (700, [1.0, 1.0], None), (10, [None, 1.0], 1), (11, [float("nan"), 1.0], 1), (12, [float("inf"), 1.0], 1), (13, [], 1)]
    asked = negatives.F.col("vec_id") % 100 == 0
    got = found(negatives.hard_negatives(table(spark, good + bad), asked))
    assert got == brute(good, lambda i: i % 100 == 0) and {r[0] for r in got} >= {100, 400, 500}
    named = [(i, v, f"class {c}") for i, v, c in good]
    assert found(negatives.hard_negatives(table(spark, named, "string"), asked)) == got
    assert negatives.hard_negatives(table(spark, good).limit(0), asked).count() == 0
    assert negatives.hard_negatives(table(spark, good), negatives.F.col("vec_id") < 0).count() == 0
