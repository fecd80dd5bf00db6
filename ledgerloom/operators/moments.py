"""Means and deviations that do not depend on the order of rows or the number of tasks.

Sums of doubles round differently whenever rows meet in another order. Here values become integers on a scale that fits
their column's range, and integers add up exactly: first the mean, then the squares of the distances from it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import safe_divide
from ledgerloom.operators.joins import attach_groups

# Steps between zero and a column's largest size: finer than a double's 53 bits.
STEPS = float(1 << 60)


def _whole_sum(share: Column) -> Column:
    """Sum of values in [-1, 1] as whole steps; up to 10^18 rows fit."""
    return F.sum(F.rint(share * F.lit(STEPS)).cast("decimal(20,0)")).cast("double") / F.lit(STEPS)


def exact_moments(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row, or one per known group, with ``{column}__n``, ``__mean``, ``__std``, ``__low`` and ``__high``.

    The deviation is that of a sample: a single value has none, equal values have 0.0. The input is read three times: for the
    ranges, the means and the deviations. NULL and NaN are left out; a column with an infinite value has neither
    mean nor deviation. An empty table gives one row without groups, and none with groups.
    """
    keys = list(by) or ["_all"]
    plain = df.dropna(subset=list(by)) if by else df.withColumn("_all", F.lit(0))
    clean = plain.select(*keys, *[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(c) for c in columns])
    ranges = clean.groupBy(*keys).agg(
        *[F.count(c).alias(f"{c}__n") for c in columns],
        *[F.min(c).alias(f"{c}__low") for c in columns],
        *[F.max(c).alias(f"{c}__high") for c in columns],
    )

    def with_sums(side: DataFrame, share: Callable[[str], Column], name: str) -> DataFrame:
        """``side`` with the sums of each value's share of its column's size."""
        sums = attach_groups(clean, side, keys).groupBy(*keys).agg(*[_whole_sum(share(c)).alias(f"{c}__{name}") for c in columns])
        return side.join(sums, keys)

    size = {c: F.greatest(F.abs(f"{c}__low"), F.abs(f"{c}__high")) for c in columns}
    finite = {c: F.when(size[c] < float("inf"), size[c]) for c in columns}
    ranges = with_sums(ranges, lambda c: F.coalesce(safe_divide(F.col(c), finite[c]), F.lit(0.0)), "sum")
    means = ranges.withColumns({f"{c}__mean": safe_divide(F.col(f"{c}__sum") * finite[c], F.col(f"{c}__n")) for c in columns})
    reach = {c: F.greatest(F.col(f"{c}__high") - F.col(f"{c}__mean"), F.col(f"{c}__mean") - F.col(f"{c}__low")) for c in columns}

    def square(c: str) -> Column:
        share = F.coalesce(safe_divide(F.col(c) - F.col(f"{c}__mean"), reach[c]), F.lit(0.0))
        return F.least(share * share, F.lit(1.0))

    full = with_sums(means, square, "square")
    if not by:
        full = df.sparkSession.range(1).select(F.lit(0).alias("_all")).join(full, "_all", "left")
    deviation = {c: reach[c] * F.sqrt(F.col(f"{c}__square") / F.nullif(F.col(f"{c}__n") - 1, F.lit(0))) for c in columns}
    return full.select(
        *by,
        *[F.coalesce(f"{c}__n", F.lit(0)).alias(f"{c}__n") for c in columns],
        *[F.col(f"{c}__mean") for c in columns],
        *[F.when(F.col(f"{c}__n") > 1, deviation[c]).alias(f"{c}__std") for c in columns],
        *[F.col(f"{c}__{end}") for c in columns for end in ("low", "high")],
    )
