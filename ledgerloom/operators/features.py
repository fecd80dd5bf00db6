"""Ratios, lags, growth rates and the fields that scoring needs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom import rules
from ledgerloom.functions.numbers import clip, relative_change, round_half_even, safe_divide
from ledgerloom.operators.clean import series_window

RatioSet = Mapping[str, tuple[str, str | None]]


def ratio_columns(ratios: RatioSet, digits: int | None = 4) -> list[Column]:
    """Compile ratio definitions to expressions."""
    compiled = []
    for name, (top, bottom) in ratios.items():
        value = F.expr(top) if bottom is None else safe_divide(F.expr(top), F.expr(bottom))
        value = value.cast("double")
        compiled.append((value if digits is None else round_half_even(value, digits)).alias(name))
    return compiled


def with_ratios(
    df: DataFrame, ratios: RatioSet = rules.QUARTERLY_RATIOS, digits: int | None = 4
) -> DataFrame:
    """All ratios in one projection, from the columns as they were before."""
    kept = [F.col(name) for name in df.columns if name not in ratios]
    return df.select(*kept, *ratio_columns(ratios, digits))


def with_lags(
    df: DataFrame,
    columns: Sequence[str] = rules.LAGGED,
    entity: str = "ticker",
    period: str = "period_end",
) -> DataFrame:
    """Value of the previous row of the company, whatever the gap in time."""
    series = series_window(entity, period)
    present = [name for name in columns if name in df.columns]
    return df.withColumns({f"{name}_lag1": F.lag(name, 1).over(series) for name in present})


def with_growth(df: DataFrame, columns: Sequence[str] = rules.GROWN, digits: int = 4) -> DataFrame:
    """Change against the previous row, relative to its absolute size."""
    grown = {}
    for name in columns:
        lag = f"{name}_lag1"
        if lag in df.columns:
            change = safe_divide(F.col(name) - F.col(lag), F.abs(F.col(lag)))
            grown[f"{name}_growth_qoq"] = round_half_even(change, digits)
    return df.withColumns(grown)


def pct_change(
    value: str, rows: int, entity: str = "ticker", order: str = "fiscal_year", pad: bool = True
) -> Column:
    """Relative change over a number of rows; with ``pad`` gaps first repeat the last value."""
    series = series_window(entity, order)
    if not pad:
        return relative_change(F.col(value), F.lag(value, rows).over(series))
    so_far = series.rowsBetween(Window.unboundedPreceding, 0)
    up_to_then = series.rowsBetween(Window.unboundedPreceding, -rows)
    return relative_change(
        F.last(value, ignorenulls=True).over(so_far), F.last(value, ignorenulls=True).over(up_to_then)
    )


def with_target_features(
    df: DataFrame,
    entity: str = "ticker",
    order: str = "fiscal_year",
    revenue: str = "total_revenue",
    pad: bool = True,
) -> DataFrame:
    """Margin, leverage, liquidity, one- and three-row growth and equity."""
    equity = F.col("total_assets") - F.col("total_liabilities")
    growth = {
        "revenue_growth": clip(pct_change(revenue, 1, entity, order, pad), -0.9, 2.0),
        "revenue_growth_3yr": clip(pct_change(revenue, 3, entity, order, pad) / 3, -0.9, 2.0),
    }
    return df.withColumns(growth).withColumns(
        {
            "net_margin": safe_divide(F.col("net_income"), F.col(revenue)),
            "debt_to_equity": clip(safe_divide(F.col("total_liabilities"), equity), 0, 20),
            "current_ratio": safe_divide(F.col("current_assets"), F.col("current_liabilities")),
            "equity": equity,
        }
    )


def latest_values(
    df: DataFrame, entity: str = "ticker", order: str = "fiscal_year", mode: str = "last_non_null"
) -> DataFrame:
    """One row per company: each column's last known value, or the latest row as it is."""
    rest = [name for name in df.columns if name not in (entity, order)]
    known = df.where(F.col(entity).isNotNull())
    if mode == "latest_row":
        picked = F.max_by(F.struct(*[F.col(name) for name in rest]), F.col(order))
        return known.groupBy(entity).agg(F.max(order).alias(order), picked.alias("_row")).select(
            entity, order, "_row.*"
        )
    if mode != "last_non_null":
        raise ValueError(f"unknown mode {mode!r}")
    return known.groupBy(entity).agg(
        F.max(order).alias(order),
        *[F.max_by(name, F.when(F.col(name).isNotNull(), F.col(order))).alias(name) for name in rest],
    )


def with_some_data(df: DataFrame, columns: Sequence[str] = ("total_assets", "total_revenue")) -> DataFrame:
    return df.where(F.coalesce(*[F.col(name) for name in columns]).isNotNull())
