"""One row per key. Spark limits each key to one row before the shuffle, so a key with very many
copies costs one row per task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import missing_count


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of every key in the given order; NULL keys are equal to each other."""
    numbered = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return numbered.where(F.col("_rn") == 1).drop("_rn")


def keep_most_complete(
    df: DataFrame,
    keys: Sequence[str],
    ties: Sequence[Column | str] = (),
    counted: Sequence[str] | None = None,
) -> DataFrame:
    """The row with the fewest NULLs; then ``ties``, then all columns, so the choice is stable.

    ``counted`` names the columns whose NULLs count; all of them if not given.
    """
    marked = df.withColumn("_missing", missing_count(list(counted or df.columns)))
    rest = [F.col(name) for name in df.columns if name not in keys]
    return keep_first(marked, keys, [F.col("_missing"), *ties, *rest]).drop("_missing")


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)
