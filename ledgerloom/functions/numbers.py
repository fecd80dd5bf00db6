"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cells per power of two in `magnitude_cell`, and cells per bucket, as powers of two. Doubles span
# fewer than 2,101 powers of two, so there are at most 2 * 2101 * 2**12 buckets of 2**20 cells, and
# a cell holds at most 2**20 different doubles, whatever the data.
CELL_BITS = 32
BUCKET_BITS = 20


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """NULL where the denominator is NULL or zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def round_half_even(value: Column, digits: int) -> Column:
    """Scale, round to the even neighbour, scale back (binary half-even rounding)."""
    scale = float(10**digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def clip(value: Column, low: float | Column | None = None, high: float | Column | None = None) -> Column:
    """Bound a value; NULL stays NULL and a missing bound does not bind."""
    bounded = value
    if low is not None:
        bounded = F.greatest(bounded, low if isinstance(low, Column) else F.lit(float(low)))
    if high is not None:
        bounded = F.least(bounded, high if isinstance(high, Column) else F.lit(float(high)))
    return F.when(value.isNotNull(), bounded)


def indicator(condition: Column) -> Column:
    """1.0 where the condition holds, 0.0 where it does not or is NULL."""
    return F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0))


def relative_change(current: Column, previous: Column) -> Column:
    """current / previous - 1 with IEEE infinities for a zero base and NULL for 0 / 0."""
    from_zero = (
        F.when(current > 0, F.lit(float("inf")))
        .when(current < 0, F.lit(float("-inf")))
    )
    return F.when(previous == 0, from_zero).otherwise(safe_divide(current, previous) - F.lit(1.0))


def magnitude_cell(value: Column) -> Column:
    """Cell number that never decreases as the value grows.

    Cells are logarithmic on both sides of zero, so heavy-tailed amounts spread evenly without a
    look at the data.
    """
    exponent = F.least(F.log2(F.abs(value)), F.lit(1024.0)) + F.lit(1076.0)
    size = F.floor(exponent * F.lit(float(1 << CELL_BITS))).cast("long")
    return F.when(value == 0, F.lit(0).cast("long")).when(value > 0, size).otherwise(-size)


def cell_bucket(cell: Column) -> Column:
    """The bucket a cell lies in; buckets are in cell order too."""
    return F.shiftright(cell, BUCKET_BITS)


def present_count(columns: list[str]) -> Column:
    """How many of the columns are not NULL."""
    total = F.lit(0)
    for name in columns:
        total = total + F.col(name).isNotNull().cast("int")
    return total


def missing_count(columns: list[str]) -> Column:
    return F.lit(len(columns)) - present_count(columns)


def exact_mean(value: Column, digits: int = 12) -> Column:
    """Mean that does not depend on the order of rows: the sum is taken in decimals of ``digits`` digits."""
    total = F.sum(value.cast(f"decimal(38,{digits})")).cast("double")
    return total / F.nullif(F.count(value), F.lit(0))
