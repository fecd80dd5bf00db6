"""Temperature mixing: sources drawn by a power of their token shares, for a token budget.

A source with the share p of all tokens gets the weight p^t / sum of p^t. t = 1 leaves the corpus as it is, t = 0 makes
all sources equal; entropy and repetition both fall as t grows, so t is bisected to meet a target entropy or a limit
on repetition. A source's part of the budget is then spent in blocks. Each block is a keyed permutation of its
documents: as many whole blocks as fit, and of the next block the first documents up to the budget.

Only sums for each source and for each of 4096 ranges of a source's permutation are gathered. Whether a document is
in the last block follows from its own key and its source's cut, so texts are not shuffled and a source may hold any
part of the rows.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm import textbytes
from ledgerloom.llm.common import ship_code, written
from ledgerloom.llm.tokens import encoder

RANGES = 4096
# Points that four halvings of an interval can visit: one pass over the sources decides four steps.
HALVINGS = 4


def _counts(tokenizer: str):
    def run(batches):
        for batch in batches:
            n = []
            for _, data, offsets in textbytes.slices(batch.column("text")):
                cuts = encoder(tokenizer).encode(data, offsets)[1]
                n += (cuts[1:] - cuts[:-1] + 1).tolist()
            keep = [x for x in batch.schema.names if x != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in keep), pa.array(n, pa.int64())], names=[*keep, "n_tokens"])

    return run


def source_key(column: str = "source") -> F.Column:
    """A source's name; NULL is a source of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def _entropy(shares: DataFrame, points: list[float]) -> list[tuple[float, float]]:
    """(sum of p^t, entropy of the weights) for each exponent, in one pass over the sources."""
    log = F.log("p")
    sums = [x for i, t in enumerate(points) for x in (F.sum(F.exp(t * log)).alias(f"z{i}"), F.sum(F.exp(t * log) * log).alias(f"s{i}"))]
    row = shares.agg(*sums).first()
    return [(row[f"z{i}"], math.log(row[f"z{i}"]) - t * row[f"s{i}"] / row[f"z{i}"]) for i, t in enumerate(points)]


def _bisect(shares: DataFrame, meets, passes: int = 10) -> float:
    """The smallest exponent in [0, 1] that ``meets`` accepts; it accepts all larger ones, and 1."""
    low, high = 0.0, 1.0
    z, h = _entropy(shares, [0.0])[0]
    if meets(0.0, z, h):
        return 0.0
    for _ in range(passes):
        inner = 2**HALVINGS
        points = [low + (high - low) * i / inner for i in range(1, inner)]
        accepted = [t for t, (z, h) in zip(points, _entropy(shares, points)) if meets(t, z, h)]
        high, low = (min(accepted), max([low, *(t for t in points if t < min(accepted))])) if accepted else (high, points[-1])
    return high


def exponent(shares: DataFrame, total: float, least: float, most: float, sources: int, *, entropy: float | None, repeats: float | None,
             budget: float | None) -> tuple[float, float]:
    """(t, token budget). ``entropy`` is a part of the largest possible one; ``budget`` None covers every source once."""

    def tokens(t: float, z: float) -> float:
        return total * budget if budget is not None else total * most ** (1 - t) * z

    def meets(t: float, z: float, h: float) -> bool:
        calm = entropy is None or h <= entropy * math.log(sources) + 1e-12
        often = tokens(t, z) * least ** (t - 1) / z / total
        return calm and (repeats is None or often <= repeats + 1e-9 or t >= 1.0)

    t = _bisect(shares, meets)
    return t, tokens(t, _entropy(shares, [t])[0][0])


def mixed(docs: DataFrame, *, entropy: float | None = None, repeats: float | None = 4.0, budget: float | None = 1.0,
          tokenizer: str = "byte_bpe_50k.json", seed: int = 17, block: str = "mix_block", position: str = "mix_position") -> DataFrame:
    """The rows of ``docs`` (doc_id, text, source, any others) as often as the mix takes them.

    ``entropy``: the weights' entropy, as a part of that of equal weights, is at most this. ``repeats``: no source is read
    more often, unless the corpus as it is already does. ``budget``: tokens of the result as a multiple of the
    corpus's tokens; None takes just enough to read every source once or more, so no document is lost. Added columns, under
    the names given by ``block`` and ``position``: 0 for a document's first use, and 0 to 1, whose ascending order
    interleaves the sources by their weights. Columns of those names are replaced, all others may have any name.
    Tokens are a text's ids plus one for its end.

    NULL text counts as empty, a NULL source is a source, and rows with NULL or repeated ids count one by one. Equal rows
    share their keys, so the cut takes all of them or none. An empty table gives an empty one.
    """
    ship_code(docs.sparkSession)
    plain = docs.drop(block, position)
    row = F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), F.col("text").cast("string"))
    slim = plain.select(source_key().alias("mix_source"), row.alias("mix_row"), F.col("text").cast("string").alias("text"))
    counted = written(slim.mapInArrow(_counts(tokenizer), "mix_source string, mix_row long, n_tokens long"))
    totals = written(counted.groupBy("mix_source").agg(F.sum("n_tokens").alias("n")))
    whole = totals.agg(F.sum("n").alias("n"), F.min("n").alias("least"), F.max("n").alias("most"), F.count(F.lit(1)).alias("k")).first()
    if not whole["k"]:
        return plain.withColumns({block: F.lit(0), position: F.lit(0.0)})
    total = float(whole["n"])
    shares = written(totals.withColumn("p", F.col("n") / total))
    t, tokens = exponent(shares, total, whole["least"] / total, whole["most"] / total, whole["k"], entropy=entropy, repeats=repeats, budget=budget)
    z = _entropy(shares, [t])[0][0]
    spent = F.exp(t * F.log("p")) / z * tokens
    # an exact multiple must not fall short by a rounding error
    blocks = F.floor(spent / F.col("n") + 1e-9)
    parts = written(shares.select("mix_source", "n", spent.alias("spent"), blocks.alias("blocks"), F.greatest(spent - blocks * F.col("n"), F.lit(0.0)).alias("rest")))

    def key(number) -> F.Column:
        return F.xxhash64("mix_row", number)

    last = counted.join(parts, "mix_source").withColumn("key", key(F.col("blocks")))
    last = last.select("mix_source", "key", "n_tokens", "rest", F.shiftright("key", 52).alias("range"))
    sums = last.groupBy("mix_source", "rest", "range").agg(F.sum("n_tokens").alias("n_tokens"))
    upto = Window.partitionBy("mix_source").orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = sums.withColumn("upto", F.sum("n_tokens").over(upto)).filter("upto > rest")
    cut_range = sums.groupBy("mix_source").agg(F.min_by(F.struct("range", (F.col("upto") - F.col("n_tokens")).alias("before")), "range").alias("cut"))
    cut_range = written(cut_range.select("mix_source", F.col("cut.range").alias("range"), F.col("cut.before").alias("before")))
    # in the one range where a source's budget ends, the first key that no longer fits
    edge = last.join(cut_range, ["mix_source", "range"]).groupBy("mix_source", "rest", "before", "key").agg(F.sum("n_tokens").alias("n_tokens"))
    inner = Window.partitionBy("mix_source").orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = edge.withColumn("upto", F.col("before") + F.sum("n_tokens").over(inner)).filter("upto > rest")
    cuts = edge.groupBy("mix_source").agg(F.min("key").alias("cut"))
    plan = written(parts.join(cuts, "mix_source", "left"))
    named = plain.select(F.struct("*").alias("mix_doc"), source_key().alias("mix_source"), row.alias("mix_row")).join(plan, "mix_source", "inner")
    partial = (F.col("rest") > 0) & (F.col("cut").isNull() | (key(F.col("blocks")) < F.col("cut")))
    uses = (F.col("blocks") + partial.cast("int")).cast("int")
    used = named.withColumn("mix_block", F.explode(F.when(uses > 0, F.sequence(F.lit(0), uses - 1))))
    order = key(F.col("mix_block").cast("long")) / F.lit(2.0**64) + 0.5
    at = (F.col("mix_block") + order) * F.col("n") / F.col("spent")
    return used.select("mix_doc.*", F.col("mix_block").alias(block), F.least(at, F.lit(1.0)).alias(position))
