"""Nearest neighbours within groups, by a balanced k-d partition.

The points of a group are cut into slabs of equal counts along the first column, each slab along the second, and so on,
by exact row numbers of a range-partitioned sort. So a cell holds at most ``CELL`` points however the values are
spread and however many points a group has. Every level keeps the boxes around its parts.

Each asked row looks into its own cell first. The distance of its last neighbour there bounds the true one, so it then
goes down the boxes that this distance reaches, and looks into their cells. A cell travels as one array, so what is
shuffled are asked rows and cells, not pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.joins import attach_groups
from ledgerloom.operators.ranks import numbered_groups
from ledgerloom.session import cut_lineage

CELL = 128
# Rows with arrays of cells or boxes that may be broadcast.
BROADCAST_ARRAYS = 1_000
# Boxes are compared with a radius that rounding cannot make too small.
SLACK = 1 + 1e-9


def kd_cells(points: DataFrame, columns: Sequence[str], keys: Sequence[str], tie: str, cell: int = CELL) -> DataFrame:
    """Points with their path ``_c0``, ``_c1``, ...: one number for each column; a whole path holds ``cell`` rows at most."""
    path: list[str] = []
    for level, column in enumerate(columns):
        numbered = numbered_groups(points, [column, *[c for c in columns if c != column], tie], [*keys, *path])
        # equal roots: the columns that follow cut each part as often as this one
        wanted = F.ceil(F.pow(F.col("_size") / cell, F.lit(1.0 / (len(columns) - level))) - 1e-9)
        # sizes of parts differ by one at most, so that no cell is too small to bound a distance
        part = F.expr("((_number - 1) * greatest(_parts, 1)) div _size").cast("int")
        numbered = numbered.withColumn("_parts", wanted)
        points = numbered.withColumn(f"_c{level}", part).drop("_number", "_size", "_parts")
        path.append(f"_c{level}")
    return points


def _boxes(cells: DataFrame, columns: Sequence[str], keys: Sequence[str], level: int) -> DataFrame:
    """For each path of ``level`` numbers, the boxes of its parts as one array."""
    path = [f"_c{i}" for i in range(level + 1)]
    sides = [F.min(f"_low_{c}").alias(f"_low_{c}") for c in columns] + [F.max(f"_high_{c}").alias(f"_high_{c}") for c in columns]
    parts = cells.groupBy(*keys, *path).agg(*sides)
    box = F.struct(F.col(f"_c{level}").alias("part"), *[f"_low_{c}" for c in columns], *[f"_high_{c}" for c in columns])
    return parts.groupBy(*keys, *path[:-1]).agg(F.collect_list(box).alias("_parts"))


def _square(columns: Sequence[str], side: Column) -> Column:
    total = F.lit(0.0)
    for name in columns:
        gap = side[name] - F.col(f"_{name}")
        total = total + gap * gap
    return total


def _near_in_cell(looking: DataFrame, cells: DataFrame, columns: Sequence[str], keys: Sequence[str], limit: int) -> DataFrame:
    """Add ``near``: the ``limit`` closest points of the cell that a row names, as (distance, peer), itself left out."""
    path = [f"_c{i}" for i in range(len(columns))]
    met = attach_groups(looking, cells.select(*keys, *path, "_points"), [*keys, *path], BROADCAST_ARRAYS)
    others = F.filter("_points", lambda p: p["peer"] != F.col("picked"))
    measured = F.transform(others, lambda p: F.struct(F.sqrt(_square(columns, p)).alias("distance"), p["peer"].alias("peer")))
    return met.withColumn("near", F.slice(F.array_sort(measured), 1, limit)).drop("_points")


def nearest_in_groups(
    points: DataFrame,
    asked: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    entity: str,
    limit: int,
    cell: int = CELL,
) -> DataFrame:
    """The ``limit`` nearest points of each asked row's group: keys, picked, peer, distance, place.

    Both tables have the keys, the entity and the columns, without NULLs; asked rows are among the points. Equal
    distances go by the peer's name. Of points at exactly one place only ``limit`` + 1 can be among the nearest of any row, so
    no more of them are kept.
    """
    carried = [F.col(name) for name in [*keys, *columns]]
    alike = Window.partitionBy(*keys, *columns).orderBy(entity)
    different = points.select(*carried, F.col(entity).alias("peer"), F.row_number().over(alike).alias("_same"))
    placed = kd_cells(different.where(F.col("_same") <= limit + 1).drop("_same"), columns, keys, "peer", max(cell, 2 * (limit + 1)))
    placed = cut_lineage(placed)
    path = [f"_c{i}" for i in range(len(columns))]
    cells = cut_lineage(
        placed.groupBy(*keys, *path).agg(
            *[F.min(c).alias(f"_low_{c}") for c in columns],
            *[F.max(c).alias(f"_high_{c}") for c in columns],
            F.collect_list(F.struct(*columns, "peer")).alias("_points"),
        )
    )
    # points at one place may lie in two cells: any of them will do as a start
    homes = placed.groupBy(*keys, *columns).agg(F.min(F.struct(*path)).alias("_home"))
    looking = attach_groups(asked, homes, [*keys, *columns]).select(
        *keys, F.col(entity).alias("picked"), *[F.col(c).alias(f"_{c}") for c in columns], "_home.*"
    )
    own = cut_lineage(_near_in_cell(looking, cells, columns, keys, limit))
    reached = F.when(F.size("near") == limit, F.element_at("near", -1)["distance"] * SLACK).otherwise(F.lit(float("inf")))
    beyond = own.select(*keys, "picked", *[f"_{c}" for c in columns], reached.alias("_reach"), *[F.col(c).alias(f"_home{c}") for c in path])
    for level in range(len(columns)):
        boxes = _boxes(cells, columns, keys, level)
        held = attach_groups(beyond, boxes, [*keys, *path[:level]], BROADCAST_ARRAYS)

        def crossed(box: Column) -> Column:
            square = F.lit(0.0)
            for c in columns:
                gap = F.greatest(box[f"_low_{c}"] - F.col(f"_{c}"), F.col(f"_{c}") - box[f"_high_{c}"], F.lit(0.0))
                square = square + gap * gap
            return F.sqrt(square) <= F.col("_reach")

        hit = F.filter("_parts", crossed)
        beyond = held.withColumn(path[level], F.explode(F.transform(hit, lambda b: b["part"]))).drop("_parts")
    home = F.lit(True)
    for c in path:
        home = home & (F.col(c) == F.col(f"_home{c}"))
    outside = _near_in_cell(beyond.where(~home), cells, columns, keys, limit)
    lists = own.select(*keys, "picked", "near").unionByName(outside.select(*keys, "picked", "near"))
    found = lists.select(*keys, "picked", F.explode("near").alias("_n")).select(*keys, "picked", "_n.peer", "_n.distance")
    order = Window.partitionBy(*keys, "picked").orderBy("distance", "peer")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= limit)
