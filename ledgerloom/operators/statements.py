"""Wide statements per company and period."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom import rules
from ledgerloom.functions.numbers import clip
from ledgerloom.operators.facts import with_calendar

STATEMENTS: Mapping[str, Sequence[str]] = {
    "balance": tuple(rules.BALANCE_SHEET),
    "income": tuple(rules.INCOME_STATEMENT),
    "cash": tuple(rules.CASH_FLOW),
}


def _spread(fields: Sequence[str], value: str) -> list[Column]:
    """One column per field. A fixed field list needs no extra job, and absent fields are NULL."""
    return [F.max(F.when(F.col("field") == name, F.col(value))).alias(name) for name in fields]


def statement_frame(
    resolved: DataFrame,
    fields: Sequence[str],
    entity: Sequence[str],
    period: str = "period_end",
    value: str = "val",
    filed: str = "filed",
) -> DataFrame:
    """One row per company and period; the filing date is that of the first field present."""
    own = resolved.where(F.col("field").isin(*fields))
    wide = own.groupBy(*entity, period).agg(
        F.min_by(filed, "field_order").alias("filing_date"), *_spread(fields, value)
    )
    return with_calendar(wide, period)


def merge_statements(
    resolved: DataFrame,
    entity: Sequence[str],
    statements: Mapping[str, Sequence[str]] = STATEMENTS,
    period: str = "period_end",
    value: str = "val",
    filed: str = "filed",
    join_on: str = "filing",
) -> DataFrame:
    """All statements on one row per company and period, the first one a company has as base.

    This is the left join of the statements on company, period and filing date, done as one
    aggregation: statements share the grain, so a row's other statements belong to it exactly
    when their filing dates are equal (NULL equals NULL). ``join_on='period'`` accepts them
    whatever their filing date. The resolved values, at most one per field and period, are
    brought together by company once; the aggregation and the window then need no shuffle, and
    the window holds a company's distinct period ends.
    """
    if join_on not in ("filing", "period"):
        raise ValueError(f"join_on must be 'filing' or 'period', not {join_on!r}")
    parts: list[Column] = []
    for name, fields in statements.items():
        order = F.when(F.col("statement") == name, F.col("field_order"))
        parts.append(F.min_by(F.col(filed), order).alias(f"_{name}_filed"))
        parts.append(F.count(order).alias(f"_{name}_rows"))
    fields_all = [field for fields in statements.values() for field in fields]
    together = resolved.repartition(*entity)
    wide = together.groupBy(*entity, period).agg(*parts, *_spread(fields_all, value))

    company = Window.partitionBy(*entity)
    base = F.coalesce(
        *[
            F.when(F.max(F.col(f"_{name}_rows")).over(company) > 0, F.lit(name))
            for name in statements
        ]
    )
    based = wide.withColumn("_base", base)
    is_base_row = F.lit(False)
    filing = F.lit(None).cast("date")
    for name in statements:
        chosen = F.col("_base") == name
        is_base_row = is_base_row | (chosen & (F.col(f"_{name}_rows") > 0))
        filing = F.when(chosen, F.col(f"_{name}_filed")).otherwise(filing)
    rows = based.withColumn("filing_date", filing).where(is_base_row)

    shown = []
    for name, fields in statements.items():
        if join_on == "filing":
            joined = F.col(f"_{name}_filed").eqNullSafe(F.col("filing_date"))
            shown += [F.when(joined, F.col(field)).alias(field) for field in fields]
        else:
            shown += [F.col(field) for field in fields]
    return with_calendar(rows.select(*entity, period, "filing_date", *shown), period)


def with_metadata(
    panel: DataFrame, universe: DataFrame, columns: Sequence[str] = ("sic_code", "sic_description", "target_sector")
) -> DataFrame:
    """Industry columns by cik. Spark broadcasts the universe only when it is small enough."""
    return panel.join(universe.select("cik", *columns), "cik", "left")


def identity_check(
    df: DataFrame,
    pct: float = rules.IDENTITY_PCT_RAW,
    floor: float = rules.IDENTITY_FLOOR,
    assets: str = "total_assets",
    liabilities: str = "total_liabilities",
    equity: str = "equity",
) -> DataFrame:
    """Assets against liabilities plus equity, within ``pct`` of assets or ``floor``."""
    gap = F.abs(F.col(assets) - (F.col(liabilities) + F.col(equity)))
    allowed = clip(F.coalesce(F.abs(F.col(assets)), F.lit(0.0)) * F.lit(pct), low=floor)
    return df.withColumns(
        {
            "balance_sheet_difference": gap,
            "balance_sheet_valid": F.coalesce(gap <= allowed, F.lit(False)),
        }
    )


def identity_counts(df: DataFrame, flag: str = "balance_sheet_valid") -> DataFrame:
    return df.agg(
        F.count_if(F.col(flag)).alias("valid"), F.count_if(~F.col(flag)).alias("invalid")
    )


def ensure_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add every missing column as a typed NULL."""
    missing = {
        name: F.lit(None).cast(kind) for name, kind in columns.items() if name not in df.columns
    }
    return df.withColumns(missing) if missing else df


def in_order(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Project to the listed columns that exist, in that order."""
    present = set(df.columns)
    return df.select(*[name for name in columns if name in present])


def concat_panels(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Stack panels by column name; columns one of them lacks are NULL there."""
    stacked = first
    for other in others:
        stacked = stacked.unionByName(other, allowMissingColumns=True)
    return stacked
