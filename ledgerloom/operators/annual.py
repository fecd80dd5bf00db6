"""One row per company and fiscal year."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom import rules
from ledgerloom.functions.numbers import present_count


def collapse_year(
    resolved: DataFrame,
    entity: Sequence[str],
    fields: Sequence[str] = rules.ANNUAL_FIELDS,
    anchors: Sequence[str] = ("total_assets", "total_revenue", "net_income"),
    year: str = "fiscal_year",
    period: str = "period_end",
    value: str = "val",
    filed: str = "filed",
) -> DataFrame:
    """Spread the fields of a year; its period end is that of the first anchor field present.

    Without an anchor the first field in dictionary order decides. The filing date is the latest
    one among the fields and the quarter is always the fourth.
    """
    ends = [
        F.max(F.when(F.col("field") == name, F.col(period))) for name in anchors
    ]
    return resolved.groupBy(*entity, year).agg(
        F.lit(4).alias("fiscal_quarter"),
        F.coalesce(*ends, F.min_by(period, "field_order")).alias(period),
        F.max(filed).alias("filing_date"),
        *[F.max(F.when(F.col("field") == name, F.col(value))).alias(name) for name in fields],
    )


def drop_sparse_rows(
    df: DataFrame,
    fields: Sequence[str] = rules.ANNUAL_FIELDS,
    at_least: int = rules.MIN_ANNUAL_FIELDS,
) -> DataFrame:
    return df.where(present_count(list(fields)) >= at_least)


def cross_fill(df: DataFrame, left: str = "net_sales", right: str = "total_revenue") -> DataFrame:
    """Fill each of two like-meaning columns from the other."""
    return df.withColumns(
        {left: F.coalesce(F.col(left), F.col(right)), right: F.coalesce(F.col(right), F.col(left))}
    )
