"""Best-fit packing of token pieces under several capacities at once.

A bin has room for tokens, documents and attention cost (the sum of squared lengths). Pieces of one length need
the same of everything, and bins with the same contents are alike, so the plan works on counts: longest pieces
first, each into the open bin that the rule prefers, for whole runs of like bins at once. It is the result of
placing the pieces one by one, but its size depends on the lengths, not on the number of pieces: each step leaves
at most one more run of like bins. Spark counts the lengths, numbers the pieces of each length and looks their
place in the plan up.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm import textbytes
from ledgerloom.llm.common import ship_code, written
from ledgerloom.llm.tokens import encoder
from ledgerloom.session import BROADCAST_ROWS

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def cut_lengths(n: int, most: int) -> list[int]:
    """Piece lengths of a document of ``n`` ids: whole pieces of ``most``, before them what is left over."""
    if n <= most:
        return [n]
    rest = n % most
    return ([rest] if rest else []) + [most] * (n // most)


def plan(counts: dict[int, int], tokens: int, documents: int, attention: int, rule: str = "norm",
         weights: tuple[float, float, float] = (1.0, 0.01, 0.01)) -> dict[str, np.ndarray]:
    """Runs of placements: piece ``rank`` .. of a length go ``copies`` to a bin from ``bin`` on, at ``offset``.

    rule "norm" takes the bin whose weighted residual norm is least after the placement (it stays the best one
    until it is full for this length), "dot" the bin with the largest weighted dot product of need and residual.
    """
    capacity = np.array([tokens, documents, attention], np.float64)
    weight = np.array(weights)
    room = np.zeros((0, 3), np.int64)  # residual of each run of like bins
    first, size = [], []
    runs: list[tuple[int, int, int, int, int, int]] = []
    bins = 0
    for length in sorted(counts, reverse=True):
        need = np.array([length, 1, length * length], np.int64)
        if (need > [tokens, documents, attention]).any():
            raise ValueError(f"a piece of {length} tokens exceeds the capacity of an empty bin")
        left, rank = counts[length], 0
        per_empty = int((np.array([tokens, documents, attention]) // need).min())
        while left:
            fits = np.flatnonzero((room >= need).all(1))
            if len(fits):
                if rule == "norm":
                    value = (weight * ((room[fits] - need) / capacity) ** 2).sum(1)
                else:
                    value = -(weight * (need / capacity) * (room[fits] / capacity)).sum(1)
                at = int(fits[np.argmin(value)])
                copies = int((room[at] // need).min()) if rule == "norm" else 1
                begin, many = first[at], size[at]
            else:
                at, copies = -1, per_empty if rule == "norm" else 1
                begin, many = bins, -(-left // copies)
                bins += many
            before = room[at] if at >= 0 else np.array([tokens, documents, attention], np.int64)
            whole = min(many, left // copies)
            rest = min(left - whole * copies, copies - 1) if whole < many else 0
            taken = whole * copies + rest
            runs.append((length, rank, taken, begin, copies, tokens - int(before[0])))
            after = []
            if whole:
                after.append((before - need * copies, begin, whole))
            if rest:
                after.append((before - need * rest, begin + whole, 1))
            if many > whole + bool(rest):
                after.append((before, begin + whole + bool(rest), many - whole - bool(rest)))
            if at >= 0:
                room = np.delete(room, at, 0)
                del first[at], size[at]
            for residual, start, number in after:
                room = np.concatenate([room, residual[None]])
                first.append(start)
                size.append(number)
            left -= taken
            rank += taken
        full = (room[:, 0] == 0) | (room[:, 1] == 0)
        if full.any():
            room = room[~full]
            first = [x for x, gone in zip(first, full) if not gone]
            size = [x for x, gone in zip(size, full) if not gone]
    names = ("length", "rank", "count", "bin", "copies", "offset")
    columns = np.array(runs, np.int64).reshape(-1, 6)
    order = np.lexsort((columns[:, 1], columns[:, 0]))
    return {name: columns[order, i] for i, name in enumerate(names)} | {"bins": np.array([bins])}


def _pieces(tokenizer: str, end_id: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen = np.zeros(most + 1, np.int64)
        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            rows: list[tuple] = []
            for first, data, offsets in textbytes.slices(batch.column("text")):
                ids, cuts = encoder(tokenizer).encode(data, offsets)
                for i in range(len(offsets) - 1):
                    own = np.append(ids[cuts[i] : cuts[i + 1]], np.uint32(end_id)).astype("<u4")
                    start = 0
                    for piece, length in enumerate(cut_lengths(len(own), most)):
                        crc = zlib.crc32(own[start : start + length].tobytes())
                        rows.append((names[first + i], piece, start, length, crc, part, int(seen[length])))
                        seen[length] += 1
                        start += length
            if rows:
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=[x.split()[0] for x in PIECES.split(", ")]
                )

    return run


def _placed(runs):
    def run(batches):
        own = runs.value
        keys = own["length"] << 40 | own["rank"]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("number").to_numpy()
            at = np.searchsorted(keys, length << 40 | rank, "right") - 1
            step = rank - own["rank"][at]
            bins = own["bin"][at] + step // own["copies"][at]
            offset = own["offset"][at] + step % own["copies"][at] * length
            columns = [batch.column(x) for x in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(bins), pa.array(offset)], names=[x.split()[0] for x in PLACED.split(", ")])

    return run


def pack(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", end_id: int = 2, tokens: int = 1024,
         documents: int | None = None, attention: int | None = None, rule: str = "norm") -> DataFrame:
    """Place every document's ids (text by ``tokenizer``, then ``end_id``) in sequences of ``tokens`` ids.

    Longer documents are cut into pieces of ``tokens`` ids, of which the first may be shorter. ``documents`` and
    ``attention`` bound the pieces of a sequence and the sum of their squared lengths; by default they hold
    whatever the token bound allows. One row for each piece: doc_id, piece, start (ids of the document before
    it), length, ids_crc32, sequence_id, offset. NULL text is empty; an empty text is its end id alone. Rows with
    NULL or repeated ids are packed like all others. An empty table gives an empty one; other columns are ignored.
    """
    spark = docs.sparkSession
    ship_code(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = written(texts.mapInArrow(_pieces(tokenizer, end_id, tokens), PIECES))
    each = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    each = written(each)
    small = each.count() <= BROADCAST_ROWS
    # one row for each length, at most ``tokens`` of them
    counts = {r["length"]: r["n"] for r in each.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = plan(counts, tokens, documents or tokens, attention or tokens * tokens, rule)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = each.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    numbered = pieces.join(F.broadcast(offsets) if small else offsets.hint("merge"), ["length", "part"]).withColumn("number", F.col("before") + F.col("rank"))
    return numbered.mapInArrow(_placed(spark.sparkContext.broadcast(runs)), PLACED)
