"""From a raw quarterly panel to a clean one with lags and growth."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerloom import rules
from ledgerloom.functions.numbers import missing_count
from ledgerloom.functions.text import normal_cik
from ledgerloom.operators import clean, dedupe, features, statements
from ledgerloom.operators.quality import cleaning_report
from ledgerloom.session import cut_lineage
from ledgerloom.sources.tables import read_panel, write_csv, write_panel

TEXTS = ("company", "ticker", "sic_description", "target_sector")


@dataclass(frozen=True)
class CleanPanel:
    panel: DataFrame
    counters: DataFrame
    dropped: list[str]


def _outside(bounds: clean.Bounds) -> Column:
    """How many values of a row the bounds move."""
    moved = F.lit(0)
    for name, (low, high) in bounds.items():
        out = (F.col(name) < low) | (F.col(name) > high)
        moved = moved + F.coalesce(out, F.lit(False)).cast("int")
    return moved


def _counted_table(df: DataFrame, helpers: list[str], **metrics: Column) -> tuple[DataFrame, dict]:
    """Write a frame out without its helper columns, taking metrics of the rows as they are written.

    The metrics belong to the last stage, whose tasks count once even when earlier stages are
    repeated after a lost executor.
    """
    seen = Observation()
    watched = df.observe(seen, *[value.alias(name) for name, value in metrics.items()])
    return cut_lineage(watched.drop(*helpers)), seen.get


def _total(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0)).cast("long")


def _present(df: DataFrame, names: tuple[str, ...]) -> list[str]:
    return [name for name in names if name in df.columns]


def clean_panel(raw: DataFrame, entity: str = "ticker", period: str = "period_end") -> CleanPanel:
    """Tidy, validate, dedupe, fill, winsorize, add lags and growth, in this order.

    The input is read once: the write before the quantile passes also takes the counts of the
    input. The panel is written again after the lag window, because the late quantiles read it more
    than once. Everything between is a projection.
    """
    signed, carried = _present(raw, rules.NOT_NEGATIVE), _present(raw, rules.CARRY_FORWARD)
    medians = _present(raw, rules.MEDIAN_FILLED)
    negative = F.lit(0).cast("long")
    for name in signed:
        negative = negative + F.coalesce((F.col(name) < 0).cast("long"), F.lit(0))
    landed, arrived = _counted_table(raw, [], rows=F.count(F.lit(1)), negative=_total(negative))

    possible = clean.drop_impossible(clean.tidy_text(landed))
    ties = [F.desc_nulls_last("filing_date")] if "filing_date" in raw.columns else []
    counted = [name for name in raw.columns if name not in TEXTS]
    unique = dedupe.keep_most_complete(possible, [entity, period], ties, counted)
    marked = unique.withColumn("_empty", missing_count(carried))
    base, filled = _counted_table(
        clean.forward_fill(marked, entity=entity, period=period),
        ["_empty"],
        rows=F.count(F.lit(1)),
        carried=_total(F.col("_empty") - missing_count(carried)),
        gaps=_total(missing_count(medians)),
    )

    imputed = clean.fill_group_median(base)
    bounds = clean.quantile_bounds(imputed)
    shown = imputed.withColumns({"_gaps": missing_count(medians), "_moved": _outside(bounds)})
    balanced = statements.identity_check(clean.clip_to_bounds(shown, bounds), rules.IDENTITY_PCT_CLEAN)
    dropped = clean.sparse_columns(balanced)
    lagged = features.with_lags(balanced.drop(*dropped), entity=entity, period=period)
    grown, clipped = _counted_table(
        features.with_growth(lagged),
        ["_gaps", "_moved"],
        gaps=_total(F.col("_gaps")),
        moved=_total(F.col("_moved")),
    )

    engineered = [name for name in grown.columns if name.endswith(("_lag1", "_growth_qoq"))]
    late_bounds = clean.quantile_bounds(grown, engineered)
    late = grown.agg(_total(_outside(late_bounds)).alias("moved")).first()["moved"]
    final = clean.clip_to_bounds(grown, late_bounds)
    if "cik" in final.columns and entity != "cik":
        final = final.withColumn("cik", normal_cik(F.col("cik")))

    counts = {
        "impossible_values_fixed": arrived["negative"],
        "duplicate_rows_removed": arrived["rows"] - filled["rows"],
        "values_forward_filled": filled["carried"],
        "values_median_filled": filled["gaps"] - clipped["gaps"],
        "values_winsorized": clipped["moved"] + late,
        "columns_dropped": len(dropped),
    }
    counters = raw.sparkSession.createDataFrame(list(counts.items()), "step string, affected bigint")
    return CleanPanel(final, counters, dropped)


def clean_files(spark: SparkSession, source: str, target: str, report: str) -> CleanPanel:
    """Read a panel CSV, clean it, and write the clean panel and the report."""
    raw = read_panel(spark, source)
    cleaned = clean_panel(raw)
    write_panel(cleaned.panel, target)
    written = spark.read.schema(cleaned.panel.schema).parquet(target)
    write_csv(cleaning_report(raw, written).coalesce(1), report)
    return cleaned
