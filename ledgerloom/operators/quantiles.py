"""Exact quantiles without gathering a column or a group in one task.

``percentile`` and ``median`` keep every distinct value of a group in the memory of one task.
Here the data is read twice instead. The first pass counts rows per logarithmic value bucket, a
table whose size depends on the range of doubles and not on the data. The buckets that hold a
wanted rank are looked up there, and the second pass looks at the values of those buckets only.
Running sums go from bucket to cell to value, so no window holds more than a few million rows
even when most values fall into one bucket.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import cell_bucket, magnitude_cell
from ledgerloom.operators.joins import lookup_join
from ledgerloom.session import BROADCAST_ROWS, small_side

BEFORE = (Window.unboundedPreceding, -1)


def melt(df: DataFrame, columns: Sequence[str] | Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Long form (by..., column, value) of the numeric columns, NULL values and keys left out."""
    named = columns if isinstance(columns, Mapping) else {name: F.col(name) for name in columns}
    wide = df.select(*by, *[value.cast("double").alias(name) for name, value in named.items()])
    known = wide.dropna(subset=list(by)) if by else wide
    return known.unpivot(list(by), list(named), "column", "value").where(F.col("value").isNotNull())


def running_rows(order: Window, rows: str = "rows") -> Column:
    """Rows of all earlier entries in the window."""
    return F.coalesce(F.sum(rows).over(order.rowsBetween(*BEFORE)), F.lit(0))


def _rows_within_bucket(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``within``: rows of the same bucket (part of ``keys``) that have a smaller value.

    ``counts`` has distinct (keys, cell, value) with their ``rows``. The sum over cells holds at
    most 2**20 cells, the one over values the doubles of one cell.
    """
    cells = counts.groupBy(*keys, "cell").agg(F.sum("rows").alias("rows"))
    by_cell = Window.partitionBy(*keys).orderBy("cell")
    offsets = cells.select(*keys, "cell", running_rows(by_cell).alias("_cells"))
    by_value = Window.partitionBy(*keys, "cell").orderBy("value")
    local = counts.withColumn("_values", running_rows(by_value))
    joined = local.join(offsets, [*keys, "cell"])
    return joined.withColumn("within", F.col("_cells") + F.col("_values")).drop("_cells", "_values")


def _bucket_offsets(histogram: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``below`` and ``total`` to rows per (keys, bucket)."""
    by_bucket = Window.partitionBy(*keys).orderBy("bucket")
    return histogram.select(
        *keys,
        "bucket",
        "rows",
        running_rows(by_bucket).alias("below"),
        F.sum("rows").over(Window.partitionBy(*keys)).alias("total"),
    )


def rows_below(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``below`` and ``total`` to distinct (keys, value) that carry their number of ``rows``."""
    cell = magnitude_cell(F.col("value"))
    placed = counts.withColumn("cell", cell).withColumn("bucket", cell_bucket(F.col("cell")))
    histogram = placed.groupBy(*keys, "bucket").agg(F.sum("rows").alias("rows"))
    offsets = _bucket_offsets(histogram, keys).drop("rows")
    within = _rows_within_bucket(placed, [*keys, "bucket"])
    joined = within.join(offsets, [*keys, "bucket"])
    return joined.withColumn("below", F.col("below") + F.col("within")).drop("bucket", "cell", "within")


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Mapping[str, float],
    by: Sequence[str] = (),
) -> DataFrame:
    """Linearly interpolated quantiles of many columns at once.

    Returns one row per (by, column) that has values, with its count ``n`` and one column per
    named probability.
    """
    keys = [*by, "column"]
    long = melt(df, columns, by).withColumn("cell", magnitude_cell(F.col("value")))
    long = long.withColumn("bucket", cell_bucket(F.col("cell")))
    histogram = long.groupBy(*keys, "bucket").agg(F.count(F.lit(1)).alias("rows"))
    offsets = _bucket_offsets(histogram, keys).withColumnRenamed("total", "n")
    places = {name: (F.col("n") - 1) * F.lit(float(p)) for name, p in probabilities.items()}
    wanted = F.lit(False)
    for place in places.values():
        for rank in (F.floor(place), F.ceil(place)):
            wanted = wanted | ((rank >= F.col("below")) & (rank < F.col("below") + F.col("rows")))
    picked = offsets.where(wanted).select(*keys, "bucket", "below", "n", "rows")
    if by:
        side, size = small_side(picked)
    else:
        # At most two buckets per column and probability.
        side, size = picked, 0
    if size <= BROADCAST_ROWS:
        near = long.join(F.broadcast(side.drop("rows")), [*keys, "bucket"])
    else:
        # A common value can fill its bucket, so buckets of very many rows are split.
        near = lookup_join(long, side, side, [*keys, "bucket"], "rows").where(F.col("n").isNotNull())
    base = [*keys, "bucket", "below", "n"]
    counts = near.groupBy(*base, "cell", "value").agg(F.count(F.lit(1)).alias("rows"))
    start = F.col("below") + F.col("within")
    placed = _rows_within_bucket(counts, base).withColumn("start", start)

    def value_at(rank: Column) -> Column:
        hit = (rank >= F.col("start")) & (rank < F.col("start") + F.col("rows"))
        return F.max(F.when(hit, F.col("value")))

    found = placed.groupBy(*keys, "n").agg(
        *[value_at(F.floor(place)).alias(f"_{name}_low") for name, place in places.items()],
        *[value_at(F.ceil(place)).alias(f"_{name}_high") for name, place in places.items()],
    )
    results = []
    for name, place in places.items():
        low, high = F.col(f"_{name}_low"), F.col(f"_{name}_high")
        results.append((low + (high - low) * (place - F.floor(place))).alias(name))
    return found.select(*keys, "n", *results)


def median_name(column: str) -> str:
    return f"{column}__median"


def group_medians(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """One row per group with the median of every column, named by :func:`median_name`."""
    medians = exact_quantiles(df, columns, {"median": 0.5}, by=[by])
    return medians.groupBy(by).agg(
        *[
            F.max(F.when(F.col("column") == name, F.col("median"))).alias(median_name(name))
            for name in columns
        ]
    )
