"""Sector-relative scores, ranking and sector summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import rules
from ledgerloom.functions.numbers import clip, indicator, round_half_even
from ledgerloom.operators.moments import exact_moments
from ledgerloom.operators.joins import attach_groups
from ledgerloom.operators.quality import unpivot_row
from ledgerloom.operators.quantiles import exact_quantiles, group_medians, median_name
from ledgerloom.operators.ranks import numbered_by_sort, percent_ranks, top_rows

SCORES = {
    "size": "size_score",
    "profit": "profit_score",
    "growth": "growth_score",
    "health": "health_score",
    "mv": "mv_score",
}
COMPOSITE = "acquirability_score"
ALL_SCORES = (COMPOSITE, *SCORES.values())
MICRO_ASSETS = 50_000_000
SMALL_FLOAT = 500_000_000
MEDIAN_MEASURES = ("total_assets", "debt_to_equity", "market_value")
CONSTANT_FILLS = {"net_margin": 0.0, "revenue_growth": 0.0, "revenue_growth_3yr": 0.0, "current_ratio": 1.0}
EXPORT = (
    "rank", "ticker", "company", "target_sector", "fiscal_year", "total_revenue", "net_income",
    COMPOSITE, "size_score", "profit_score", "growth_score", "health_score", "mv_score",
    "revenue_growth", "net_margin", "thesis",
)


def sector_ranks(
    df: DataFrame, sector: str = "target_sector", entity: str = "ticker", **options: int
) -> DataFrame:
    """Percent rank in the sector of every scored measure, gaps filled first; one row per company."""
    with_medians = attach_groups(df, group_medians(df, MEDIAN_MEASURES, sector), [sector])
    measures = {
        name: F.coalesce(F.col(name), F.col(median_name(name))) for name in MEDIAN_MEASURES
    } | {name: F.coalesce(F.col(name), F.lit(fill)) for name, fill in CONSTANT_FILLS.items()}
    ranks = percent_ranks(with_medians, entity, sector, measures, **options)
    return ranks.select(entity, *[F.col(name).alias(f"{name}__rank") for name in measures])


def score_expressions() -> dict[str, Column]:
    """The five scores, 0 to 100; a company without a sector counts as the middle of its group."""
    def rank(name: str) -> Column:
        return F.col(f"{name}__rank")

    def high(name: str) -> Column:
        return F.coalesce(rank(name), F.lit(0.5))

    def low(name: str) -> Column:
        return F.coalesce(F.lit(1.0) - rank(name), F.lit(0.5))

    def below(name: str, limit: float) -> Column:
        return indicator(F.coalesce(F.col(name), F.lit(0.0)) < limit)

    earning = indicator(F.col("net_income") > 0)
    retained = indicator(F.col("retained_earnings") > 0)
    return {
        "size_score": clip(low("total_assets") + below("total_assets", MICRO_ASSETS) * 0.15, 0, 1) * 100,
        "profit_score": (high("net_margin") * 0.60 + earning * 0.40) * 100,
        "growth_score": (high("revenue_growth") * 0.60 + high("revenue_growth_3yr") * 0.40) * 100,
        "health_score": (
            low("debt_to_equity") * 0.30 + high("current_ratio") * 0.30 + earning * 0.20 + retained * 0.20
        )
        * 100,
        "mv_score": clip(low("market_value") + below("market_value", SMALL_FLOAT) * 0.10, 0, 1) * 100,
    }


def with_scores(
    df: DataFrame, sector: str = "target_sector", entity: str = "ticker", **options: int
) -> DataFrame:
    """Add the five scores to a snapshot with one row per company.

    The snapshot is read several times, so hand in a written table when it is costly to compute.
    """
    scored = df.join(sector_ranks(df, sector, entity, **options), entity, "left")
    return scored.select(*df.columns, *[value.alias(name) for name, value in score_expressions().items()])


def composite(weights: Mapping[str, float]) -> Column:
    total = F.lit(0.0)
    for part, column in SCORES.items():
        total = total + F.col(column) * F.lit(float(weights[part]))
    return total


def with_composite(df: DataFrame, preset: str = "balanced") -> DataFrame:
    return df.withColumn(COMPOSITE, composite(rules.WEIGHTS[preset]))


def thesis_label(sector: str = "target_sector") -> Column:
    """Words for a company's profile, from its scores."""
    size, growth = F.col("size_score"), F.col("growth_score")
    profit, health = F.col("profit_score"), F.col("health_score")
    cap = (
        F.when(size >= 80, "Micro-cap").when(size >= 60, "Small-cap").when(size <= 30, "Large-cap")
    ).otherwise("Mid-cap")
    pace = F.when(F.col("revenue_growth") > 0.3, "high-growth").otherwise("steady-grower")
    words = F.concat_ws(
        " / ",
        cap,
        F.when(growth >= 75, pace),
        F.when(profit >= 75, "high-margin").when(profit <= 35, "turnaround-candidate"),
        F.when(health >= 75, "low-debt").when(health <= 35, "distressed"),
    )
    return F.concat(words, F.lit(" "), F.coalesce(F.col(sector), F.lit("nan")), F.lit(" target"))


def rank_targets(df: DataFrame, entity: str = "ticker", preset: str = "balanced") -> DataFrame:
    """Composite score, thesis and overall rank of every scored company."""
    labelled = with_composite(df, preset).withColumn("thesis", thesis_label())
    ranked = numbered_by_sort(labelled, [F.desc_nulls_last(COMPOSITE), F.col(entity)], name="rank")
    return ranked.withColumn("rank", F.col("rank").cast("int"))


def export_columns(df: DataFrame) -> DataFrame:
    return df.select(*[name for name in EXPORT if name in df.columns])


def top_targets(scored: DataFrame, limit: int, entity: str = "ticker") -> DataFrame:
    """Best companies without ranking the rest; each task keeps only ``limit`` rows."""
    return top_rows(scored, limit, [F.desc_nulls_last(COMPOSITE), F.col(entity)])


def score_stats(df: DataFrame, columns: Sequence[str] = ALL_SCORES) -> DataFrame:
    """Mean, median, sample deviation, least and greatest value per score; the same bits for any order of rows."""
    one_row = exact_moments(df, columns)
    cells = [
        F.struct(
            F.lit(name).alias("column"), F.col(f"{name}__mean").alias("mean"), F.col(f"{name}__std").alias("std"),
            F.col(f"{name}__low").alias("min"), F.col(f"{name}__high").alias("max"),
        )
        for name in columns
    ]
    moments = one_row.select(F.inline(F.array(*cells)))
    medians = exact_quantiles(df, columns, {"median": 0.5}).drop("n")
    return moments.join(medians, "column", "left")


def sector_summary(
    df: DataFrame, sector: str = "target_sector", entity: str = "ticker", digits: int = 1
) -> DataFrame:
    """Mean scores, best company and company count per sector."""
    means = {"avg_score": COMPOSITE, "size": "size_score", "profit": "profit_score",
             "growth": "growth_score", "health": "health_score", "float": "mv_score"}
    best = F.min(F.struct((-F.col(COMPOSITE)).alias("order"), F.col(entity).alias("entity")))
    grouped = df.where(F.col(sector).isNotNull()).groupBy(sector).agg(
        *[round_half_even(F.avg(column), digits).alias(name) for name, column in means.items()],
        F.count(entity).alias("companies"),
        best.alias("_best"),
    )
    return grouped.select(sector, *means, F.col("_best.entity").alias("top_target"), "companies")


def dimension_matrix(summary: DataFrame, sector: str = "target_sector") -> DataFrame:
    """(sector, dimension, score) rows of a sector summary."""
    names = ["size", "profit", "growth", "health", "float"]
    return summary.unpivot([sector], names, "dimension", "score")


def dimension_profile(top: DataFrame, entity: str = "ticker") -> DataFrame:
    """(company, dimension, score) rows of a few companies."""
    return top.unpivot([entity], list(SCORES.values()), "dimension", "score")


def score_histogram(df: DataFrame, columns: Sequence[str] = ALL_SCORES, bins: int = 30) -> DataFrame:
    """Equal-width bins between the least and greatest value of each score, with its mean and median.

    The last bin includes its upper edge; a constant score is centred in a width of one.
    """
    spans = df.agg(
        *[F.struct(F.min(name).alias("lo"), F.max(name).alias("hi"), F.avg(name).alias("mean")).alias(name)
          for name in columns]
    )
    cells = [F.struct(F.lit(name).alias("column"), F.col(name).alias("s")) for name in columns]
    edges = spans.select(F.inline(F.array(*cells))).select("column", "s.*")
    flat = F.col("lo") == F.col("hi")
    medians = exact_quantiles(df, columns, {"median": 0.5}).select("column", "median")
    edges = edges.join(F.broadcast(medians), "column").select(
        "column",
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        "mean",
        "median",
    )
    values = [F.struct(F.lit(name).alias("column"), F.col(name).alias("value")) for name in columns]
    long = df.select(F.inline(F.array(*values))).where(F.col("value").isNotNull())
    share = (F.col("value") - F.col("lo")) * bins / (F.col("hi") - F.col("lo"))
    bin_number = F.least(F.floor(share), F.lit(bins - 1)).cast("int")
    # One row per score column, so the edges are broadcast.
    return (
        long.join(F.broadcast(edges), "column")
        .groupBy("column", bin_number.alias("bin"), "lo", "hi", "mean", "median")
        .agg(F.count(F.lit(1)).alias("companies"))
        .select("column", "bin", "lo", "hi", "mean", "median", "companies")
    )


def companies_per_sector(df: DataFrame, sector: str = "target_sector", entity: str = "ticker") -> DataFrame:
    return df.groupBy(sector).agg(F.count_distinct(entity).alias("companies"))


def feature_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Coverage, median and 99th percentile per derived field."""
    shares = df.agg(*[(F.avg(F.col(c).isNotNull().cast("int")) * 100).alias(c) for c in columns])
    covered = unpivot_row(shares, columns, "column", "coverage_pct", "double")
    quantiles = exact_quantiles(df, columns, {"median": 0.5, "p99": 0.99}).drop("n")
    return covered.join(quantiles, "column", "left")
