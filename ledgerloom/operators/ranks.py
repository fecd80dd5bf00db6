"""Ranks inside groups of any size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.joins import HOT_ROWS, lookup_join
from ledgerloom.operators.quantiles import melt, rows_below, running_rows
from ledgerloom.session import BROADCAST_ROWS, cut_lineage, small_side

def percent_ranks(
    df: DataFrame,
    key: str,
    by: str,
    measures: Mapping[str, Column],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Average-tie percent rank of several measures within ``by``, one row per ``key`` of ``df``.

    A measure's rank is (rows below + (ties + 1) / 2) / rows with a value. NULL measures and
    rows without a group have the rank NULL. All measures share one pass: equal values are counted
    first, ranks are computed on distinct values, and rows look theirs up.
    """
    long = melt(df, measures, [by, key])
    group = [by, "column"]
    counts = long.groupBy(*group, "value").agg(F.count(F.lit(1)).alias("rows"))
    ranked = rows_below(counts, group).select(
        *group,
        "value",
        "rows",
        ((F.col("below") + (F.col("rows") + 1) / 2) / F.col("total")).alias("rank"),
    )
    looked_up = lookup_join(long, ranked, counts, [*group, "value"], "rows", hot_rows)
    unranked = df.select(key, F.lit(None).cast("string").alias("column"), F.lit(None).cast("double").alias("rank"))
    return looked_up.select(key, "column", "rank").unionByName(unranked).groupBy(key).agg(
        *[F.max(F.when(F.col("column") == name, F.col("rank"))).alias(name) for name in measures]
    )


def numbered_groups(df: DataFrame, order: Sequence[Column | str], by: Sequence[str]) -> DataFrame:
    """Add ``_number`` (1..n in the order, per group) and ``_size`` (rows of the group).

    Spark's range-partitioned sort does the work: the sorted rows are written once, and a row's
    number is its place in its partition plus the rows that came before the partition. The
    helper table has one row per partition and group inside it.
    """
    sorted_rows = df.orderBy(*by, *order).withColumn("_id", F.monotonically_increasing_id())
    saved = cut_lineage(sorted_rows).withColumn("_part", F.shiftright("_id", 33))
    blocks = saved.groupBy("_part", *by).agg(
        F.min("_id").alias("_first"), F.count(F.lit(1)).alias("rows")
    )
    group = Window.partitionBy(*by)
    starts = blocks.select(
        F.col("_part").alias("_block"),
        *[F.col(key).alias(f"_by_{key}") for key in by],
        "_first",
        running_rows(group.orderBy("_part")).alias("_before"),
        F.sum("rows").over(group).alias("_size"),
    )
    side, rows = small_side(starts)
    same = saved["_part"] == F.col("_block")
    for key in by:
        same = same & saved[key].eqNullSafe(F.col(f"_by_{key}"))
    # Beyond the broadcast limit a join key still has no more rows than one sorted partition.
    joined = saved.join(F.broadcast(side) if rows <= BROADCAST_ROWS else side, same)
    number = F.col("_before") + F.col("_id") - F.col("_first") + 1
    return joined.select(*df.columns, number.cast("long").alias("_number"), "_size")


def numbered_by_sort(
    df: DataFrame, order: Sequence[Column | str], by: Sequence[str] = (), name: str = "rank"
) -> DataFrame:
    """Row numbers 1..n in a total order, over everything or within groups of any size."""
    placed = numbered_groups(df, order, by)
    return placed.select(*df.columns, F.col("_number").alias(name))


def ntile_by_sort(
    df: DataFrame, tiles: int, order: Sequence[Column | str], by: Sequence[str], name: str = "tile"
) -> DataFrame:
    """Equal-sized tiles in sorted order; the first (rows mod tiles) tiles are one row larger."""
    small, larger = F.expr(f"_size div {tiles}"), F.expr(f"_size % {tiles}")
    head = larger * (small + 1)
    place = F.col("_number") - 1
    in_head = F.floor(place / (small + 1)) + 1
    in_tail = larger + F.floor((place - head) / F.greatest(small, F.lit(1))) + 1
    tile = F.when(place < head, in_head).otherwise(in_tail).cast("int")
    return numbered_groups(df, order, by).select(*df.columns, tile.alias(name))


def top_rows(df: DataFrame, limit: int, order: Sequence[Column | str]) -> DataFrame:
    """The first rows in the given order; every task keeps only ``limit`` of them."""
    return df.orderBy(*order).limit(limit)
