"""Exact top-k inner products by columnar branch and bound.

Vectors become integers, floor(scale * x). Candidates lie in blocks in vertical layout, one row a dimension.
A block of queries accumulates inner products a few dimensions at a time, heaviest dimensions first. What the other
dimensions can still add is at most the product of the remaining lengths of both vectors (Cauchy-Schwarz), so a
candidate whose upper bound is below the k-th best lower bound leaves, and the survivors are compacted.

Candidate blocks are dealt once into parts of a fixed number of blocks; the query blocks go to every part and meet its
blocks one after the other, so the k-th scores of one block prune the next. k rows a query leave a part, and a
limited ranking merges them. No task grows with the table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import parts, ship_code, written
from ledgerloom.llm.vectors import usable

QUERY_BLOCK = 512
CANDIDATE_BLOCK = 4096
DIMENSIONS = 16

# Candidate blocks that a part holds in memory.
HELD = 8

BLOCKS = "dim int, first long, ids binary, rows binary, grid binary"
FOUND = "query_row long, query_id long, vec_id long, row long, score long"


def _blocks(scale: float, size: int):
    """Blocks of up to ``size`` vectors of one dimension, as a vertical grid of integers held in doubles."""

    def run(batches):
        held: dict[int, tuple[list, list, list]] = {}

        def emit(dim: int) -> pa.RecordBatch:
            ids, rows, vectors = held.pop(dim)
            grid = np.ascontiguousarray(np.floor(scale * np.stack(vectors)).T)
            row = [[dim], [rows[0]], [np.array(ids, np.int64).tobytes()], [np.array(rows, np.int64).tobytes()], [grid.tobytes()]]
            kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, kinds)], names=[x.split()[0] for x in BLOCKS.split(", ")])

        for batch in batches:
            names, places = batch.column("vec_id").to_pylist(), batch.column("row").to_pylist()
            at, vectors = usable(batch.column("embedding"))
            for i, vector in zip(at, vectors):
                ids, rows, own = held.setdefault(len(vector), ([], [], []))
                ids.append(names[i])
                rows.append(places[i])
                own.append(vector)
                if len(ids) == size:
                    yield emit(len(vector))
        for dim in sorted(held):
            yield emit(dim)

    return run


def best(queries: np.ndarray, query_rows: np.ndarray, grid: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int, floor: np.ndarray):
    """(query place, candidate place, score) of each query's k best in a vertical ``grid``, ties to smaller ids.

    A query does not meet its own row; ``rows`` and ``query_rows`` tell rows apart, whatever their ids.
    ``floor``: scores already known to be reached by k other candidates; lower ones need not be returned.
    """
    order = np.argsort(-np.abs(queries).sum(0) * np.abs(grid).sum(1), kind="stable")
    queries, grid = queries[:, order], grid[order]
    cuts = list(range(0, len(order), DIMENSIONS)) + [len(order)]
    rest_q = np.sqrt(np.cumsum((queries**2)[:, ::-1], 1)[:, ::-1])
    rest_c = np.sqrt(np.cumsum((grid**2)[::-1], 0)[::-1])
    partial = queries[:, : cuts[1]] @ grid[: cuts[1]]
    out_q, out_c, out_s = [], [], []
    for q in range(len(queries)):
        alive = np.flatnonzero(rows != query_rows[q])
        score = partial[q, alive]
        for b in range(1, len(cuts)):
            if b > 1:
                score = score + queries[q, cuts[b - 1] : cuts[b]] @ grid[cuts[b - 1] : cuts[b], alive]
            if cuts[b] < len(order):
                reach = rest_q[q, cuts[b]] * rest_c[cuts[b], alive] * (1 + 1e-9) + 1e-6
            else:
                reach = 0.0
            bound = floor[q]
            if len(alive) > k:
                low = score - reach
                bound = max(bound, np.partition(low, len(low) - k)[len(low) - k])
            stay = score + reach >= bound
            if not stay.all():
                alive, score = alive[stay], score[stay]
        top = np.lexsort((ids[alive], -score))[:k]
        out_q.append(np.full(len(top), q))
        out_c.append(alive[top])
        out_s.append(score[top])
    return np.concatenate(out_q), np.concatenate(out_c), np.concatenate(out_s)


def _parts(k: int):
    """Candidate blocks of a part come first and are held; query blocks pass by and take their k best along."""

    def run(batches):
        key, blocks = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if key != (row["part"], row["dim"]):
                    key, blocks = (row["part"], row["dim"]), []
                ids, rows = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["rows"], np.int64)
                grid = np.frombuffer(row["grid"], np.float64).reshape(row["dim"], -1)
                if row["side"] == 0:
                    blocks.append((grid, ids, rows))
                elif blocks:
                    yield _met(grid.T, ids, rows, blocks, k)

    return run


def _met(queries: np.ndarray, query_ids: np.ndarray, query_rows: np.ndarray, blocks: list[tuple], k: int) -> pa.RecordBatch:
    top = np.full((len(query_ids), k), -np.inf)  # each query's best scores so far
    found = []
    for grid, ids, rows in blocks:
        q, c, s = best(queries, query_rows, grid, ids, rows, k, top[:, k - 1])
        found.append((q, ids[c], rows[c], s))
        for i in range(len(query_ids)):
            top[i] = -np.sort(-np.concatenate([top[i], s[q == i]]))[:k]
    q, ids, rows, s = (np.concatenate(x) for x in zip(*found))
    keep = s >= top[q, k - 1]
    order = np.lexsort((rows, ids, -s, q))
    order = order[keep[order]]
    q, ids, rows, s = q[order], ids[order], rows[order], s[order]
    # of ties for the last place, the first k rows of each query
    place = np.arange(len(q)) - np.searchsorted(q, q, "left")
    q, ids, rows, s = (x[place < k] for x in (q, ids, rows, s))
    columns = (query_rows[q], query_ids[q], ids, rows, s.astype(np.int64))
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=[x.split()[0] for x in FOUND.split(", ")])


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0) -> DataFrame:
    """Each query row's ``k`` largest integer inner products: query_id, rank (from 1), vec_id, score.

    ``vectors`` has vec_id and embedding; other columns serve ``is_query`` only, which says of each row whether it is
    asked. Components become floor(scale * x). Vectors that are NULL, empty or hold NULL or non-finite components take
    no part, and neither do NULL ids. Candidates are all rows but the query's own, so a row that repeats its id
    or its vector is met like any other, and is asked by itself. Ties go to the smaller id. Vectors of another
    dimension do not meet. A query without candidates has no rows.
    """
    spark = vectors.sparkSession
    ship_code(spark)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", is_query.alias("asked"))
    rows = written(rows.filter("vec_id is not null and embedding is not null").withColumn("row", F.monotonically_increasing_id()))
    many, asked = rows.count(), rows.filter("asked").select("vec_id", "row", "embedding")
    if asked.isEmpty():
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    def blocks(df: DataFrame, size: int) -> DataFrame:
        return written(df.repartition(max(1, min(parts(spark), -(-many // size)))).mapInArrow(_blocks(scale, size), BLOCKS))

    n_parts = max(-(-many // (CANDIDATE_BLOCK * HELD)), min(parts(spark), -(-many // CANDIDATE_BLOCK)), 1)
    candidates = blocks(rows.select("vec_id", "row", "embedding"), CANDIDATE_BLOCK)
    candidates = candidates.withColumn("part", F.pmod(F.xxhash64("first"), F.lit(n_parts)).cast("int")).withColumn("side", F.lit(0))
    queries = blocks(asked, QUERY_BLOCK).withColumn("side", F.lit(1))
    queries = queries.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))))
    met = candidates.unionByName(queries).repartition(parts(spark), "part").sortWithinPartitions("part", "dim", "side")
    found = met.mapInArrow(_parts(k), FOUND)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
