"""Product quantisation against brute force on planted near copies."""

from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from ledgerloom.llm import pq


def planted(rng, n, dim):
    base = rng.normal(0, 1, (n, dim))
    base /= np.linalg.norm(base, axis=1)[:, None]
    near = []
    for i in range(0, 40):
        for _ in range(1 + i % 7):
            v = base[i] + rng.normal(0, 0.3 / np.sqrt(dim) * rng.random(), dim)
            near.append(v / np.linalg.norm(v))
    chain = [base[50]]
    for _ in range(6):
        v = chain[-1] + rng.normal(0, 0.25 / np.sqrt(dim), dim)
        chain.append(v / np.linalg.norm(v))
    hot = base[60] + rng.normal(0, 0.2 / np.sqrt(dim), (200, dim))
    return np.concatenate([base, near, chain[1:], hot]).astype(np.float32)


def brute(x, cosine):
    u = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1)[:, None]
    linked = u @ u.T >= cosine
    np.fill_diagonal(linked, False)
    label = np.arange(len(x))
    while True:
        low = np.minimum(label, np.where(linked, label[None, :], len(x)).min(1))
        if (low == label).all():
            return linked.sum(1), label
        label = low


def test_links_and_components_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(pq, "ENTRIES", 64)  # lists split into several cells on both sides
    monkeypatch.setattr(pq, "QUERIES", 100)
    monkeypatch.setattr(pq, "LISTS", 16)
    x = planted(np.random.default_rng(4), 700, 64)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {r.vec_id: r for r in pq.near_duplicates(df, 0.95).collect()}
    links, label = brute(x, 0.95)
    assert len(got) == len(x)
    assert [got[i].n_links for i in range(len(x))] == links.tolist()
    assert [got[i].component_id for i in range(len(x))] == label.tolist()
    assert all(got[i].kept == (got[i].component_id == i) for i in range(len(x)))


def test_awkward_vectors(spark):
    rows = [
        (7, [1.0, 0.0, 0.0]), (3, [2.0, 0.0, 0.0]), (5, [1.0, 0.0, 0.0]), (1, None), (2, [0.0, 0.0, 0.0]), (4, [1.0, None, 0.0]),
        (6, [float("inf"), 0.0, 0.0]), (8, [1.0, 0.0]), (9, []), (None, [0.0, 1.0, 0.0]), (10, [0.0, 5.0, 0.1]), (10, [0.0, 5.0, 0.1]),
        (11, [1e200, 1e200, 0.0]), (12, [1e-200, 1e-200, 0.0]),
    ]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, node long, list string")
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in pq.near_duplicates(df).collect()), key=str)
    want = sorted([
        (7, 2, 3), (3, 2, 3), (5, 2, 3), (1, 0, 1), (2, 0, 2), (4, 0, 4), (6, 0, 6), (8, 0, 8), (9, 0, 9),
        (None, 2, 10), (10, 2, 10), (10, 2, 10), (11, 1, 11), (12, 1, 11),
    ], key=str)
    assert got == want
    assert pq.near_duplicates(df.limit(0)).count() == 0


def test_links_across_a_boundary_count_for_both_ends():
    x = np.array([[np.cos(a), np.sin(a)] for a in np.linspace(0.0, 1.4, 30)])
    coarse = np.zeros((2, 8))  # all differences lie along the line between both centroids
    coarse[:, :2] = [[np.cos(0.35), np.sin(0.35)], [np.cos(1.05), np.sin(1.05)]]
    model = SimpleNamespace(value={"coarse": coarse, "books": np.zeros((8, 4, 1))})
    reach = float(np.sqrt(2 - 2 * 0.95))
    vectors = pa.RecordBatch.from_pydict({"node": list(range(30)), "weight": [1 + i % 3 for i in range(30)], "v": [v.tobytes() for v in x]})
    rows = pa.Table.from_batches(pq._index(model, 2, 8, reach)([vectors]))
    rows = rows.append_column("salt", pa.array([0] * rows.num_rows)).sort_by([("list", "ascending"), ("role", "ascending")]).combine_chunks()
    links = np.zeros(30, np.int64)
    for batch in pq._cells(model, 2, 8, 0.95, reach)(rows.to_batches()):
        np.add.at(links, batch["node"].to_numpy(), batch["links"].to_numpy())
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    assert links.tolist() == (near @ (1 + np.arange(30) % 3)).tolist()


def test_every_row_has_a_result(spark):
    rows = [(1, [1.0, 0.0]), (1, None), (None, [0.0, 1.0]), (None, []), (None, [0.0, 0.0]), (2, None)]
    got = pq.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted(((r.vec_id, r.n_links) for r in got), key=str) == sorted([(1, 0), (1, 0), (None, 0), (None, 0), (None, 0), (2, 0)], key=str)
