"""Coverage, validation and description of panels, as tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import rules
from ledgerloom.functions.numbers import round_half_even
from ledgerloom.operators.clean import numeric_columns
from ledgerloom.operators.quantiles import exact_quantiles


def unpivot_row(one_row: DataFrame, names: Sequence[str], label: str, value: str, kind: str) -> DataFrame:
    """Turn the columns of a one-row aggregate into (label, value) rows."""
    cells = [F.struct(F.lit(name).alias(label), F.col(name).cast(kind).alias(value)) for name in names]
    return one_row.select(F.inline(F.array(*cells)))


def coverage(df: DataFrame, columns: Sequence[str] | None = None, digits: int = 1) -> DataFrame:
    """Percent of non-NULL values per numeric column."""
    names = list(columns) if columns is not None else numeric_columns(df)
    shares = df.agg(
        *[
            round_half_even(F.avg(F.col(name).isNotNull().cast("int")) * 100, digits).alias(name)
            for name in names
        ]
    )
    return unpivot_row(shares, names, "column", "coverage_pct", "double")


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULLs per column, the emptiest first."""
    names = list(columns) if columns is not None else df.columns
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in names])
    return unpivot_row(counts, names, "column", "missing", "bigint").orderBy(F.desc("missing"), "column")


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    counts = df.agg(*[F.count_distinct(F.col(name)).alias(name) for name in columns])
    return unpivot_row(counts, columns, "column", "distinct_values", "bigint")


def value_counts(df: DataFrame, column: str, name: str = "rows") -> DataFrame:
    """Rows per value, NULL included, the most frequent first."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), column)


def duplicate_rows(df: DataFrame, keys: Sequence[str], name: str = "duplicates") -> DataFrame:
    """Rows beyond the first of each key, as one row; NULL keys are equal to each other."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return counts.agg(F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias(name))


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [name for name in required if name not in df.columns]


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Fail on missing columns or an empty table."""
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    if df.isEmpty():
        raise ValueError("the table is empty")
    return df


def schema_report(
    df: DataFrame,
    entity: str = "ticker",
    period: str = "period_end",
    required: Sequence[str] = rules.PANEL_REQUIRED,
) -> DataFrame:
    """(metric, column, value) rows: missing columns, duplicates, years, quarters, coverage."""
    metrics: dict[tuple[str, str], Column] = {
        ("missing_column", name): F.lit(1) for name in missing_columns(df, required)
    }
    if "fiscal_year" in df.columns:
        year = F.col("fiscal_year")
        metrics["fiscal_year_min", "fiscal_year"] = F.min(year)
        metrics["fiscal_year_max", "fiscal_year"] = F.max(year)
        metrics["unreasonable_fiscal_years", "fiscal_year"] = F.count_if((year < 1990) | (year > 2030))
    if "fiscal_quarter" in df.columns:
        valid = F.coalesce(F.col("fiscal_quarter").isin(1, 2, 3, 4), F.lit(False))
        metrics["valid_quarters", "fiscal_quarter"] = F.bool_and(valid).cast("int")
    for name in numeric_columns(df):
        share = F.avg(F.col(name).isNotNull().cast("int")) * 100
        metrics["coverage_pct", name] = round_half_even(share, 1)
    one_row = df.agg(*[value.cast("double").alias(f"m{i}") for i, value in enumerate(metrics.values())])
    cells = [
        F.struct(F.lit(metric).alias("metric"), F.lit(column).alias("column"), F.col(f"m{i}").alias("value"))
        for i, (metric, column) in enumerate(metrics)
    ]
    report = one_row.select(F.inline(F.array(*cells)))
    if not {entity, period} <= set(df.columns):
        return report
    repeated = duplicate_rows(df, [entity, period]).select(
        F.lit("duplicate_keys").alias("metric"), F.lit("").alias("column"), F.col("duplicates").cast("double").alias("value")
    )
    return report.unionByName(repeated)


def cleaning_report(raw: DataFrame, clean: DataFrame, entity: str = "ticker") -> DataFrame:
    """(section, metric, column, value) rows about a panel before and after cleaning."""
    def size(df: DataFrame, section: str) -> DataFrame:
        counted = df.agg(F.count(F.lit(1)).cast("double").alias("rows"))
        cells = [
            F.struct(F.lit("rows").alias("metric"), F.col("rows").alias("value")),
            F.struct(F.lit("columns").alias("metric"), F.lit(float(len(df.columns))).alias("value")),
        ]
        return counted.select(F.inline(F.array(*cells))).select(
            F.lit(section).alias("section"), "metric", F.lit("").alias("column"), "value"
        )

    before, after = size(raw, "before"), size(clean, "after")
    signed = F.when(F.col("section") == "before", F.col("value")).otherwise(-F.col("value"))
    removed = (
        before.unionByName(after)
        .where(F.col("metric") == "rows")
        .agg(F.sum(signed).alias("value"))
        .select(F.lit("removed").alias("section"), F.lit("rows").alias("metric"), F.lit("").alias("column"), "value")
    )
    schema = schema_report(clean, entity).withColumn("section", F.lit("schema"))
    return before.unionByName(after).unionByName(removed).unionByName(schema)


def describe_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max per column."""
    one_row = df.agg(
        *[
            F.struct(
                F.count(F.col(name)).alias("count"),
                F.avg(name).alias("mean"),
                F.stddev_samp(name).alias("std"),
                F.min(F.col(name).cast("double")).alias("min"),
                F.max(F.col(name).cast("double")).alias("max"),
            ).alias(name)
            for name in columns
        ]
    )
    cells = [F.struct(F.lit(name).alias("column"), F.col(name).alias("s")) for name in columns]
    moments = one_row.select(F.inline(F.array(*cells))).select("column", "s.*")
    quartiles = exact_quantiles(df, columns, {"q25": 0.25, "q50": 0.5, "q75": 0.75}).drop("n")
    return moments.join(quartiles, "column", "left")


def describe_texts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, distinct values, and the most frequent value (least text among equals)."""
    cells = [F.struct(F.lit(name).alias("column"), F.col(name).cast("string").alias("text")) for name in columns]
    long = df.select(F.inline(F.array(*cells))).where(F.col("text").isNotNull())
    counted = long.groupBy("column", "text").agg(F.count(F.lit(1)).alias("rows"))
    best = F.min(F.struct((-F.col("rows")).alias("order"), F.col("text")))
    return counted.groupBy("column").agg(
        F.sum("rows").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        best.alias("_best"),
    ).select(
        "column", "count", "unique", F.col("_best.text").alias("top"), (-F.col("_best.order")).alias("freq")
    )


def match_summary(df: DataFrame, stages: Mapping[str, Column]) -> DataFrame:
    """Rows that pass each named stage of a universe build and all stages before it, counted in one pass."""
    passed, counts = F.lit(True), {}
    for name, condition in stages.items():
        passed = passed & F.coalesce(condition, F.lit(False))
        counts[name] = F.count_if(passed)
    cells = [F.struct(F.lit(i).alias("step"), F.lit(name).alias("stage"), F.col(name).alias("rows")) for i, name in enumerate(counts)]
    return df.agg(*[value.alias(name) for name, value in counts.items()]).select(F.inline(F.array(*cells)))
