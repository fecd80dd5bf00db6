"""Panel cleaning steps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import rules
from ledgerloom.functions.numbers import clip
from ledgerloom.functions.text import tidy_company, tidy_ticker
from ledgerloom.operators.joins import attach_groups
from ledgerloom.operators.quantiles import exact_quantiles, group_medians, median_name

Bounds = Mapping[str, tuple[float, float]]


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Number-typed columns; flags are not numbers."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def measure_columns(df: DataFrame) -> list[str]:
    return numeric_columns(df, rules.NOT_MEASURES)


def tidy_text(df: DataFrame) -> DataFrame:
    """Company names, tickers and sector texts in one clean form; NULL stays NULL."""
    edits = {
        "company": tidy_company,
        "ticker": tidy_ticker,
        "sic_description": F.trim,
        "target_sector": F.trim,
    }
    return df.withColumns({name: edit(F.col(name)) for name, edit in edits.items() if name in df.columns})


def drop_impossible(df: DataFrame, columns: Sequence[str] = rules.NOT_NEGATIVE) -> DataFrame:
    """Negative values of amounts that cannot be negative become NULL."""
    present = [name for name in columns if name in df.columns]
    return df.withColumns({name: F.when(F.col(name) >= 0, F.col(name)) for name in present})


def impossible_counts(df: DataFrame, columns: Sequence[str] = rules.NOT_NEGATIVE) -> DataFrame:
    """How many values of each column :func:`drop_impossible` removes."""
    present = [name for name in columns if name in df.columns]
    one_row = df.agg(*[F.count_if(F.col(name) < 0).alias(name) for name in present])
    cells = [F.struct(F.lit(name).alias("column"), F.col(name).alias("fixed")) for name in present]
    return one_row.select(F.inline(F.array(*cells)))


def series_window(entity: str, period: str) -> Window:
    """A company's rows in time order.

    Meant for panels with one row per company and period end, so a partition is never longer
    than the number of distinct dates.
    """
    return Window.partitionBy(entity).orderBy(F.col(period).asc_nulls_last())


def forward_fill(
    df: DataFrame,
    columns: Sequence[str] = rules.CARRY_FORWARD,
    entity: str = "ticker",
    period: str = "period_end",
) -> DataFrame:
    """Carry the last known value of each column forward; all columns share one window."""
    so_far = series_window(entity, period).rowsBetween(Window.unboundedPreceding, 0)
    present = [name for name in columns if name in df.columns]
    return df.withColumns({name: F.last(name, ignorenulls=True).over(so_far) for name in present})


def fill_group_median(
    df: DataFrame, columns: Sequence[str] = rules.MEDIAN_FILLED, by: str = "fiscal_year"
) -> DataFrame:
    """Fill gaps with the exact median of the row's group; a row without a group loses its values."""
    present = [name for name in columns if name in df.columns]
    joined = attach_groups(df, group_medians(df, present, by), [by])
    filled = {
        name: F.when(F.col(by).isNotNull(), F.coalesce(F.col(name), F.col(median_name(name))))
        for name in present
    }
    return joined.withColumns(filled).select(*df.columns)


def quantile_bounds(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    lower: float = 0.01,
    upper: float = 0.99,
    min_values: int = 100,
) -> Bounds:
    """Exact clipping bounds per column; columns with too few values get none.

    At most one row per column comes to the driver.
    """
    names = measure_columns(df) if columns is None else [name for name in columns if name in df.columns]
    if not names:
        return {}
    found = exact_quantiles(df, names, {"low": lower, "high": upper})
    rows = found.where(F.col("n") >= min_values).collect()
    return {row["column"]: (row["low"], row["high"]) for row in rows}


def clip_to_bounds(df: DataFrame, bounds: Bounds) -> DataFrame:
    """Clip by literal bounds: a plain projection with no join."""
    return df.withColumns({name: clip(F.col(name), low, high) for name, (low, high) in bounds.items()})


def outside_counts(df: DataFrame, bounds: Bounds) -> DataFrame:
    """How many values of each column :func:`clip_to_bounds` moves."""
    hits = [
        F.count_if((F.col(name) < low) | (F.col(name) > high)).alias(name) for name, (low, high) in bounds.items()
    ]
    cells = [F.struct(F.lit(name).alias("column"), F.col(name).alias("clipped")) for name in bounds]
    return df.agg(*hits).select(F.inline(F.array(*cells)))


def winsorize(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    lower: float = 0.01,
    upper: float = 0.99,
    min_values: int = 100,
) -> DataFrame:
    return clip_to_bounds(df, quantile_bounds(df, columns, lower, upper, min_values))


def sparse_columns(df: DataFrame, threshold: float = rules.MIN_COVERAGE) -> list[str]:
    """Measures whose share of non-NULL values is below the threshold (one aggregate row)."""
    names = measure_columns(df)
    if not names:
        return []
    shares = df.agg(*[F.avg(F.col(name).isNotNull().cast("int")).alias(name) for name in names]).first()
    return [name for name in names if shares[name] is not None and shares[name] < threshold]


def drop_sparse_columns(df: DataFrame, threshold: float = rules.MIN_COVERAGE) -> DataFrame:
    return df.drop(*sparse_columns(df, threshold))
