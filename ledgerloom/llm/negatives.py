"""Hard negatives by Fagin's threshold algorithm over blocks of sorted candidate lists.

Vectors become integers, floor(scale * x). Rows sorted by label are cut into blocks that keep, besides the integers, one
list a dimension with the block's rows in order of that component; a label of any size fills many blocks. An anchor
goes down the lists of a block, from the largest component where its own is positive and from the smallest where it
is negative. Rows met for the first time are scored by random access. The anchor's product with the components at the
present depth bounds every row that was not met, and a block is left as soon as this threshold is strictly below the
k-th score of each window: ties by id stay open until then. Blocks come in order of their threshold at depth zero,
and k-th scores carry over, so most blocks are never entered.

Two rounds: the first has one open window over the rows of the anchor's label and gives its positives, the second one
window of allowed scores for each positive over the rows of other labels. Candidates are dealt once into parts of a
fixed number of blocks, and the anchors (far fewer) go to every part. What leaves a part are k rows a window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import parts, ship_code, written

# Rows of a block (row numbers in the lists have 16 bits), blocks of a part, anchors handed over together.
BLOCK = 4096
HELD = 16
ANCHORS = 256
# Depths at which the threshold is looked at; the last one is the block's end.
DEPTHS = (0, 16, 64, 256, 1024)
EXACT = float(1 << 53)

PACKED = "dim int, first long, kind string, ids binary, rows binary, labels binary, grid binary, lists binary, windows binary"
FOUND = "anchor_row long, slot int, anchor_id long, positive_id long, positive_score long, vec_id long, row long, score long"


def _packed(scale: float, size: int, lists: bool):
    """Blocks of up to ``size`` rows of one dimension, in the order they come."""

    def emit(rows: list[dict]) -> pa.RecordBatch:
        grid = np.floor(scale * np.array([r["embedding"] for r in rows], np.float64))
        top = np.abs(grid).max()
        kind = next((k for k, most in (("i2", 2**15), ("i4", 2**31)) if top < most), "f8")
        order = np.argsort(grid.T, axis=1, kind="stable").astype(np.uint16).tobytes() if lists else b""
        windows = [[[x["vec_id"], x["score"]] for x in r["positives"]] for r in rows]
        most = max(map(len, windows))
        filled = [w + [[0, 0]] * (most - len(w)) for w in windows]
        own = [len(w) for w in windows]
        out = {
            "dim": [grid.shape[1]], "first": [rows[0]["row"]], "kind": [kind], "grid": [grid.astype(kind).tobytes()], "lists": [order],
            "windows": [np.array([most, *own, *np.array(filled, np.int64).ravel()], np.int64).tobytes()],
        }
        for name, column in (("ids", "vec_id"), ("rows", "row"), ("labels", "label")):
            out[name] = [np.array([r[column] for r in rows], np.int64).tobytes()]
        kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        fields = [f.split() for f in PACKED.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(out[n], kinds[t]) for n, t in fields], names=[n for n, _ in fields])

    def run(batches):
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and (len(held) == size or len(row["embedding"]) != len(held[0]["embedding"])):
                    yield emit(held)
                    held = []
                held.append(row)
        if held:
            yield emit(held)

    return run


class _Block:
    def __init__(self, row: dict):
        self.ids, self.rows, self.labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "rows", "labels"))
        self.grid = np.frombuffer(row["grid"], row["kind"]).reshape(len(self.ids), row["dim"]).astype(np.float64)
        self.top = np.abs(self.grid).max() if self.grid.size else 0.0
        windows = np.frombuffer(row["windows"], np.int64)
        self.slots = windows[1 : 1 + len(self.ids)]
        self.positives = windows[1 + len(self.ids) :].reshape(len(self.ids), windows[0], 2)
        if row["lists"]:
            self.order = np.frombuffer(row["lists"], np.uint16).reshape(row["dim"], -1)
            self.depths = [d for d in DEPTHS if d < len(self.ids)] + [len(self.ids)]
            at = np.array(self.depths[:-1])
            # components at the depths, from the largest and from the smallest one on
            column = np.arange(row["dim"])[:, None]
            self.largest = self.grid[self.order[:, len(self.ids) - 1 - at], column]
            self.smallest = self.grid[self.order[:, at], column]

    def thresholds(self, anchors: np.ndarray) -> np.ndarray:
        """For each anchor and depth, what a row that was not met before can score at most."""
        return np.maximum(anchors, 0) @ self.largest + np.minimum(anchors, 0) @ self.smallest


def whole_numbers(grid: np.ndarray) -> np.ndarray:
    """Python integers, for products that doubles cannot hold exactly."""
    return np.array([[int(x) for x in row] for row in grid], object).reshape(grid.shape)


class Search:
    """One anchor's windows: at most ``k`` rows each, with scores from ``lows`` to ``highs``."""

    def __init__(self, anchor: np.ndarray, lows: list, highs: list, k: int):
        self.anchor, self.k = anchor, k
        self.lows, self.highs = lows, highs
        self.needs = list(lows)  # a window's k-th score once it has k rows
        self.dims = np.flatnonzero(anchor != 0)
        self.down = anchor[self.dims] > 0
        if not len(self.dims):
            self.dims, self.down = np.array([0]), np.array([True])
        self.found: list[tuple] = []  # (-score, id, row)

    def enter(self, block: _Block, grid: np.ndarray, anchor: np.ndarray, allowed: np.ndarray, thresholds: np.ndarray) -> int:
        """Go down the lists of a block; how many rows were scored."""
        n, scored = len(block.ids), 0
        seen = np.zeros(n, bool)
        lists = block.order[self.dims]
        for depth, stop, bound in zip(block.depths, block.depths[1:], thresholds):
            if bound < min(self.needs):
                break
            met = np.zeros(n, bool)
            met[lists[self.down, n - stop : n - depth]] = True
            met[lists[~self.down, depth:stop]] = True
            at = np.flatnonzero(met & ~seen & allowed)
            seen |= met
            if len(at):
                scored += len(at)
                self.take(grid[at] @ anchor, block.ids[at], block.rows[at])
        return scored

    def take(self, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        keep = np.flatnonzero((scores >= min(self.needs)) & (scores <= max(self.highs)))
        if not len(keep):
            return
        if len(keep) > 4 * self.k * len(self.needs):
            # of many new rows, each window's best k with all ties are enough
            wanted = np.zeros(len(keep), bool)
            for low, high in zip(self.needs, self.highs):
                within = np.flatnonzero((scores[keep] >= low) & (scores[keep] <= high))
                if len(within) > self.k:
                    kth = np.partition(scores[keep[within]], len(within) - self.k)[len(within) - self.k]
                    within = within[scores[keep[within]] >= kth]
                wanted[within] = True
            keep = keep[wanted]
        self.found = sorted(self.found + [(-int(s), int(i), int(r)) for s, i, r in zip(scores[keep], ids[keep], rows[keep])])
        chosen = [self.window(w) for w in range(len(self.needs))]
        for w, own in enumerate(chosen):
            if len(own) == self.k:
                self.needs[w] = max(self.needs[w], -own[-1][0])
        self.found = sorted(set().union(*chosen))

    def window(self, w: int) -> list[tuple]:
        out = []
        for entry in self.found:
            if -self.highs[w] <= entry[0] <= -self.lows[w]:
                out.append(entry)
                if len(out) == self.k:
                    break
        return out


def search_part(anchors: _Block, blocks: list[_Block], k: int, other: bool, low: int, high: int):
    """(anchor place, slot, found entries) of one block of anchors against the blocks of a part."""
    wide = anchors.top * max(b.top for b in blocks) * anchors.grid.shape[1] >= EXACT
    own = whole_numbers(anchors.grid) if wide else anchors.grid
    if wide:
        for b in blocks:
            b.largest, b.smallest = whole_numbers(b.largest), whole_numbers(b.smallest)
    bounds = [b.thresholds(own) for b in blocks]
    labels = [set(np.unique(b.labels).tolist()) for b in blocks]
    for i in range(len(anchors.ids)):
        label = int(anchors.labels[i])
        if other:
            scores = [int(p[1]) for p in anchors.positives[i, : anchors.slots[i]]]
            slots = [(s, -(-low * p // 100), high * p // 100) for s, p in enumerate(scores)]
            slots = [x for x in slots if x[1] <= x[2]]
        else:
            slots = [(0, -np.inf, np.inf)]
        if not slots:
            continue
        search = Search(anchors.grid[i], [x[1] for x in slots], [x[2] for x in slots], k)
        for j in sorted(range(len(blocks)), key=lambda j: -bounds[j][i, 0]):
            block = blocks[j]
            if bounds[j][i, 0] < min(search.needs):
                break
            if label in labels[j] if not other else labels[j] != {label}:
                same = block.labels == label
                allowed = ~same if other else same & (block.rows != anchors.rows[i])
                grid = whole_numbers(block.grid) if wide else block.grid
                search.enter(block, grid, own[i], allowed, bounds[j][i])
        for w, (slot, *_) in enumerate(slots):
            yield i, slot, search.window(w)


def _parts(k: int, other: bool, low: int, high: int):
    """Candidate blocks of a part come first and are held; then anchors pass by."""

    def run(batches):
        key, blocks = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if key != (row["part"], row["dim"]):
                    key, blocks = (row["part"], row["dim"]), []
                if row["side"] == 0:
                    blocks.append(_Block(row))
                    continue
                if not blocks:
                    continue
                anchors, out = _Block(row), []
                for i, slot, entries in search_part(anchors, blocks, k, other, low, high):
                    positive = anchors.positives[i, slot].tolist() if other else [0, 0]
                    for minus, vec_id, at in entries:
                        score = min(max(-minus, -(1 << 63)), (1 << 63) - 1)
                        out.append((int(anchors.rows[i]), slot, int(anchors.ids[i]), *positive, vec_id, at, score))
                if out:
                    fields = [f.split() for f in FOUND.split(", ")]
                    arrays = [pa.array(c, pa.int32() if t == "int" else pa.int64()) for c, (_, t) in zip(zip(*out), fields)]
                    yield pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in fields])

    return run


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: float = 256.0
) -> DataFrame:
    """Negatives for each anchor and positive: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors``: vec_id, embedding, label; other columns serve ``is_anchor`` only. Components become floor(scale * x); a score
    is the integer inner product with the anchor, exact in all of long's range (beyond it, its end). Higher scores come first, ties by smaller vec_id. Positives are the first ``positives`` other rows of the anchor's
    label; negatives the first ``negatives`` rows of other labels whose score is ``low`` to ``high`` percent of the
    positive's. Rows with a NULL id, label or vector, an empty vector, or a NULL or non-finite component take no part.
    Vectors of another dimension do not meet. Repeated rows count one by one, as anchors too. A positive without
    negatives has no rows; empty tables give none.
    """
    spark = vectors.sparkSession
    ship_code(spark)
    kind = vectors.schema["label"].dataType.typeName()
    label = F.col("label").cast("long") if kind in ("byte", "short", "integer", "long") else F.xxhash64(F.col("label").cast("string"))
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull())
    rows = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), F.col("embedding").cast("array<double>").alias("embedding"), is_anchor.alias("asked")
    )
    rows = written(rows.filter(whole & (F.size("embedding") > 0)).withColumn("row", F.monotonically_increasing_id()))
    many = rows.count()
    dim = F.size("embedding")
    none = F.array().cast("array<struct<vec_id:long,score:long>>").alias("positives")

    def dealt(df: DataFrame, size: int, lists: bool) -> DataFrame:
        ordered = df.repartitionByRange(min(parts(spark), -(-many // size) or 1), dim, "label", "row").sortWithinPartitions(dim, "label", "row")
        return written(ordered.select("vec_id", "row", "label", "embedding", "positives").mapInArrow(_packed(scale, size, lists), PACKED))

    blocks = dealt(rows.select("*", none), BLOCK, True)
    n_parts = max(-(-many // (BLOCK * HELD)), min(parts(spark), -(-many // BLOCK)), 1)
    candidates = blocks.withColumn("part", F.pmod(F.xxhash64("first"), F.lit(n_parts)).cast("int")).withColumn("side", F.lit(0))
    anchors = rows.filter("asked")

    def searched(asked: DataFrame, k: int, other: bool) -> DataFrame:
        every = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1)))).withColumn("side", F.lit(1))
        met = candidates.unionByName(every).repartition(parts(spark), "part").sortWithinPartitions("part", "dim", "side")
        found = met.mapInArrow(_parts(k, other, low, high), FOUND)
        order = Window.partitionBy("anchor_row", "slot").orderBy(F.desc("score"), "vec_id", "row")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    best = searched(dealt(anchors.select("*", none), ANCHORS, False), positives, False)
    ranked = best.groupBy("anchor_row").agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("ranked"))
    listed = F.transform("ranked", lambda x: F.struct(x["vec_id"].alias("vec_id"), x["score"].alias("score"))).alias("positives")
    with_positives = anchors.join(ranked, anchors.row == ranked.anchor_row).select(*rows.columns, listed)
    mined = searched(dealt(with_positives, ANCHORS, False), negatives, True)
    return mined.select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
