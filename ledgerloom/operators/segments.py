"""Forward fill and lags over series of any length.

A window per series puts a whole series into one task: too much for one series, or the rows without a ticker, that
hold a large part of a table. Here rows are sorted by ranges over series and order, so a long series fills several
partitions. Windows then run inside (partition, series), and what crosses a border goes through a table of a few
rows a partition: the last known values, or the last rows, of the series that a partition ends with.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import BROADCAST_ROWS, cut_lineage, small_side


def _sorted(df: DataFrame, series: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Rows with their place ``_id`` in the whole order and their partition ``_part``; written once."""
    rows = df.orderBy(*series, *order).withColumn("_id", F.monotonically_increasing_id())
    return cut_lineage(rows).withColumn("_part", F.shiftright("_id", 33))


def _border(saved: DataFrame, series: Sequence[str], last: bool) -> DataFrame:
    """The series that each partition ends (or begins) with: one row a partition."""
    end = F.max_by if last else F.min_by
    edge = saved.groupBy("_part").agg(end(F.struct(*series), "_id").alias("_series"))
    return edge.select("_part", *[F.col(f"_series.{name}").alias(name) for name in series])


def _same(series: Sequence[str], left: str, right: str) -> Column:
    same = F.lit(True)
    for name in series:
        same = same & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return same


def _at_border(saved: DataFrame, border: DataFrame, series: Sequence[str]) -> DataFrame:
    """Rows of the series that their partition ends or begins with."""
    edge, rows = small_side(border)
    edge = F.broadcast(edge.alias("b")) if rows <= BROADCAST_ROWS else edge.alias("b")
    on = (F.col("r._part") == F.col("b._part")) & _same(series, "r", "b")
    return saved.alias("r").join(edge, on, "left_semi")


def forward_fill_long(df: DataFrame, columns: Sequence[str], series: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Carry the last known value of each column forward within a series, in the given total order.

    Rows whose series is NULL are one series, as in a window.
    """
    saved = _sorted(df, series, order)
    so_far = Window.partitionBy("_part", *series).orderBy("_id").rowsBetween(Window.unboundedPreceding, 0)
    local = saved.withColumns({name: F.last(name, ignorenulls=True).over(so_far) for name in columns})
    ends = _at_border(saved, _border(saved, series, True), series).groupBy("_part", *series).agg(
        *[F.max_by(name, F.when(F.col(name).isNotNull(), F.col("_id"))).alias(name) for name in columns]
    )
    starts = _border(saved, series, False).select("_part", *series, *[F.lit(None).cast(saved.schema[n].dataType).alias(n) for n in columns])
    both = starts.withColumn("_asks", F.lit(True)).unionByName(ends.withColumn("_asks", F.lit(False)))
    # a series has two rows a partition here, however long it is
    before = Window.partitionBy(*series).orderBy("_part", F.desc("_asks")).rowsBetween(Window.unboundedPreceding, -1)
    carried = both.withColumns({name: F.last(name, ignorenulls=True).over(before) for name in columns}).where("_asks")
    side, rows = small_side(carried.select("_part", *series, *[F.col(name).alias(f"_carried_{name}") for name in columns]))
    side = F.broadcast(side.alias("c")) if rows <= BROADCAST_ROWS else side.alias("c")
    met = local.alias("l").join(side, (F.col("l._part") == F.col("c._part")) & _same(series, "l", "c"), "left")
    filled = [
        F.coalesce(f"l.{name}", f"c._carried_{name}").alias(name) if name in columns else F.col(f"l.{name}") for name in df.columns
    ]
    return met.select(*filled)


def lag_long(df: DataFrame, lags: Mapping[str, tuple[str, int]], series: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Add columns ``{new: (column, rows back)}`` of earlier rows of the series, in the given total order."""
    most = max(back for _, back in lags.values())
    sources = sorted({column for column, _ in lags.values()})
    saved = _sorted(df, series, order)
    inside = Window.partitionBy("_part", *series).orderBy("_id")
    local = saved.withColumns({new: F.lag(column, back).over(inside) for new, (column, back) in lags.items()})
    local = local.withColumn("_row", F.row_number().over(inside))

    def edge_rows(last: bool) -> DataFrame:
        way = Window.partitionBy("_part", *series).orderBy(F.desc("_id") if last else F.col("_id"))
        rows = _at_border(saved, _border(saved, series, last), series).withColumn("_n", F.row_number().over(way))
        return rows.where(F.col("_n") <= most).select("_id", *series, *sources, F.lit(not last).alias("_asks"))

    # the first and the last few rows of each partition; a row can be both
    edges = edge_rows(True).unionByName(edge_rows(False))
    edges = edges.groupBy("_id").agg(*[F.first(name).alias(name) for name in [*series, *sources]], F.max("_asks").alias("_asks"))
    along = Window.partitionBy(*series).orderBy("_id")
    names = {new: f"_over_{new}" for new in lags}
    crossed = edges.withColumns({names[new]: F.lag(column, back).over(along) for new, (column, back) in lags.items()})
    side, rows = small_side(crossed.where("_asks").select(F.col("_id").alias("_edge"), *names.values()))
    side = F.broadcast(side) if rows <= BROADCAST_ROWS else side
    met = local.join(side, F.col("_id") == F.col("_edge"), "left")
    chosen = {
        new: F.when((F.col("_row") <= back) & F.col("_edge").isNotNull(), F.col(names[new])).otherwise(F.col(new))
        for new, (_, back) in lags.items()
    }
    return met.withColumns(chosen).select(*df.columns, *lags)
