"""Sector, health and time-series analyses over annual panels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import exact_mean, indicator, round_half_even, safe_divide
from ledgerloom.operators.clean import series_window
from ledgerloom.operators.dedupe import keep_first
from ledgerloom.operators.joins import attach_groups
from ledgerloom.operators.moments import exact_moments
from ledgerloom.operators.nearest import nearest_in_groups
from ledgerloom.operators.quantiles import exact_quantiles
from ledgerloom.operators.ranks import ntile_by_sort
from ledgerloom.session import cut_lineage

GROUP = ("target_sector", "fiscal_year")


def _grouped(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose group is fully known."""
    return df.dropna(subset=list(keys))


def join_external(panel: DataFrame, other: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Prices, macro series or ratings by shared columns; the panel keeps all its rows by default."""
    clash = (set(panel.columns) & set(other.columns)) - set(on)
    if clash:
        raise ValueError(f"both tables have {sorted(clash)}")
    return panel.join(other, list(on), how)


def group_mean(df: DataFrame, column: str, keys: Sequence[str] = GROUP, name: str | None = None) -> DataFrame:
    return _grouped(df, keys).groupBy(*keys).agg(exact_mean(F.col(column)).alias(name or f"{column}_mean"))


def group_volatility(df: DataFrame, column: str, keys: Sequence[str] = GROUP) -> DataFrame:
    moments = exact_moments(cut_lineage(_grouped(df, keys).select(*keys, column)), [column], keys)
    return moments.select(*keys, F.col(f"{column}__std").alias(f"{column}_std"))


def best_in_group(
    df: DataFrame, column: str, keys: Sequence[str] = GROUP, ties: Sequence[str] = ("ticker",)
) -> DataFrame:
    """The row with the greatest value in every group that has one."""
    known = _grouped(df, keys).where(F.col(column).isNotNull())
    return keep_first(known, keys, [F.desc(column), *ties])


SCREENS: Mapping[str, str] = {
    "liquidity_risk": "try_divide(current_assets, current_liabilities) < 1.0",
    "over_leveraged": "try_divide(total_liabilities, total_assets) > 0.8",
    "growth": "revenue_growth > 0.2 and net_income > 0",
}


def with_screens(df: DataFrame, screens: Mapping[str, str] = SCREENS) -> DataFrame:
    """One flag per screen; a screen that cannot be judged is not met."""
    return df.withColumns({name: F.coalesce(F.expr(rule), F.lit(False)) for name, rule in screens.items()})


def screened(df: DataFrame, screens: Mapping[str, str] = SCREENS) -> DataFrame:
    """(row, screen) pairs for every screen a row meets."""
    names = [F.when(F.expr(rule), F.lit(name)) for name, rule in screens.items()]
    met = F.array_compact(F.array(*names))
    return df.withColumn("screen", F.explode(met))


def loss_runs(
    df: DataFrame,
    entity: str = "ticker",
    step: str = "fiscal_year",
    income: str = "net_income",
    at_least: int = 2,
) -> DataFrame:
    """Unbroken runs of consecutive years with a loss.

    ``step`` is a whole number that grows by one per period; rows per company are bounded by
    its periods.
    """
    losses = df.where((F.col(income) < 0) & F.col(step).isNotNull())
    place = F.row_number().over(Window.partitionBy(entity).orderBy(step))
    runs = losses.withColumn("_run", F.col(step) - place)
    return (
        runs.groupBy(entity, "_run")
        .agg(F.min(step).alias("first"), F.max(step).alias("last"), F.count(F.lit(1)).alias("length"))
        .where(F.col("length") >= at_least)
        .drop("_run")
    )


def cash_burners(
    df: DataFrame,
    entity: str = "ticker",
    order: str = "fiscal_year",
    income: str = "net_income",
    at_least: int = 2,
) -> DataFrame:
    """Companies with repeated losses while working capital fell, and how often that happened."""
    series = series_window(entity, order)
    capital = F.col("current_assets") - F.col("current_liabilities")
    dated = df.withColumn("_capital", capital).withColumns(
        {
            "_fell": F.col("_capital") < F.lag("_capital", 1).over(series),
            "_loss": F.col(income) < 0,
            "_before": F.lag(F.col(income) < 0, 1).over(series),
        }
    )
    burning = F.col("_loss") & F.col("_before") & F.col("_fell")
    counted = dated.groupBy(entity).agg(F.count_if(burning).alias("burning_periods"))
    return counted.where(F.col("burning_periods") >= at_least - 1)


def event_study(
    df: DataFrame,
    column: str,
    before: tuple[int, int],
    after: tuple[int, int],
    sector: str = "target_sector",
    year: str = "fiscal_year",
) -> DataFrame:
    """Mean of an amount per sector in two year windows, and the change."""
    def window_mean(span: tuple[int, int]) -> Column:
        return exact_mean(F.when(F.col(year).between(*span), F.col(column)), 4)

    means = df.where(F.col(sector).isNotNull()).groupBy(sector).agg(
        window_mean(before).alias("before"), window_mean(after).alias("after")
    )
    return means.withColumn("change", F.col("after") - F.col("before"))


def size_quintiles(
    df: DataFrame,
    column: str = "market_value",
    year: str = "fiscal_year",
    ties: Sequence[str] = ("ticker",),
    tiles: int = 5,
) -> DataFrame:
    """Equal-sized size classes within every year, smallest first."""
    known = df.where(F.col(column).isNotNull() & F.col(year).isNotNull())
    return ntile_by_sort(known, tiles, [F.col(column), *ties], [year], "quintile")


def sector_benchmarks(df: DataFrame, columns: Sequence[str], sector: str = "target_sector") -> DataFrame:
    """Mean and exact median of every ratio per sector."""
    cells = [F.struct(F.lit(name).alias("column"), F.col(name).alias("value")) for name in columns]
    long = _grouped(df, [sector]).select(sector, F.inline(F.array(*cells)))
    means = long.groupBy(sector, "column").agg(F.avg("value").alias("mean"), F.count("value").alias("companies"))
    medians = exact_quantiles(df, columns, {"median": 0.5}, by=[sector]).drop("n")
    return means.join(medians, [sector, "column"], "left")


def with_group_moments(df: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Rows of known groups, with mean and sample deviation of the columns in their group."""
    known = cut_lineage(_grouped(df, keys))
    wanted = [f"{name}__{part}" for name in columns for part in ("mean", "std")]
    moments = exact_moments(known, columns, keys).select(*keys, *wanted)
    return attach_groups(known, moments, keys)


def outliers(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("target_sector",), limit: float = 3.0
) -> DataFrame:
    """(row, column, value, z) for values further than ``limit`` deviations from the group mean."""
    joined = with_group_moments(df, columns, keys)
    cells = [
        F.struct(
            F.lit(name).alias("column"),
            F.col(name).alias("value"),
            safe_divide(F.col(name) - F.col(f"{name}__mean"), F.col(f"{name}__std")).alias("z"),
        )
        for name in columns
    ]
    carried = [F.col(name) for name in df.columns if name not in columns]
    return joined.select(*carried, F.inline(F.array(*cells))).where(F.abs("z") > limit)


def closest_peers(
    df: DataFrame,
    picked: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = GROUP,
    entity: str = "ticker",
    limit: int = 5,
) -> DataFrame:
    """Nearest companies in the group of each picked one, by distance of standardised columns.

    ``picked`` holds the entity and group keys of the companies asked about, any number of them. Rows: the group keys,
    picked, peer, distance and place, ``limit`` of them where the group is large enough.
    """
    joined = with_group_moments(df, columns, keys)
    scaled = cut_lineage(
        joined.select(
            *keys,
            entity,
            *[
                safe_divide(F.col(name) - F.col(f"{name}__mean"), F.col(f"{name}__std")).alias(name)
                for name in columns
            ],
        ).dropna(subset=[*keys, *columns])
    )
    asked = scaled.join(picked.select(*keys, entity), [*keys, entity], "left_semi")
    return nearest_in_groups(scaled, asked, columns, keys, entity, limit)


def with_health_flag(
    df: DataFrame, revenue: str = "total_revenue", income: str = "net_income"
) -> DataFrame:
    """Margin, liquidity and leverage with positive denominators only, and the healthy flag."""
    equity = F.col("total_assets") - F.col("total_liabilities")

    def positive(top: Column, bottom: Column) -> Column:
        return F.when(bottom > 0, safe_divide(top, bottom))

    rated = df.withColumns(
        {
            "net_margin": positive(F.col(income), F.col(revenue)),
            "current_ratio": positive(F.col("current_assets"), F.col("current_liabilities")),
            "debt_to_equity": positive(F.col("total_liabilities"), equity),
        }
    )
    healthy = (F.col("current_ratio") > 1.5) & (F.col("debt_to_equity") < 1.0) & (F.col("net_margin") > 0.05)
    return rated.withColumn("healthy", F.coalesce(healthy, F.lit(False)))


def healthy_summary(
    df: DataFrame, year: int, sector: str = "target_sector", digits: int = 4
) -> DataFrame:
    """Sector means of one year's ratios and share of healthy companies; ``df`` carries the flag."""
    one_year = df.where((F.col("fiscal_year") == year) & F.col(sector).isNotNull())
    means = {name: exact_mean(F.col(name)) for name in ("net_margin", "current_ratio", "debt_to_equity")}
    means["healthy"] = F.avg(indicator(F.col("healthy")))
    return one_year.groupBy(sector).agg(
        *[round_half_even(value, digits).alias(name) for name, value in means.items()]
    )
