"""Joining every row with the one row of its group, however many rows a group has."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import BROADCAST_ROWS, small_side

# No task of a lookup join gets more rows of one key than this; keys with more are split.
HOT_ROWS = 5_000_000


def lookup_join(
    left: DataFrame,
    lookup: DataFrame,
    weights: DataFrame,
    keys: Sequence[str],
    weight: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left join with ``lookup``, which has at most one row per key.

    ``weight`` says how many left rows a key has, in ``lookup`` and in ``weights``. A key with
    more than ``hot_rows`` is split: its rows are salted and its lookup row is copied once per
    salt. There are at most (left rows) / ``hot_rows`` such keys, so their list is broadcast.
    Rows with a NULL key match nothing and are spread by their hash.
    """
    copies = F.ceil(F.col(weight) / hot_rows)
    hot = weights.where(F.col(weight) > hot_rows).select(*keys, copies.alias("_copies"))
    row_hash = F.xxhash64(*[F.col(name) for name in left.columns])
    keyless = reduce(lambda a, b: a | b, [F.col(key).isNull() for key in keys])
    salt = F.when(keyless, row_hash).otherwise(F.pmod(row_hash, F.coalesce(F.col("_copies"), F.lit(1))))
    salted = left.join(F.broadcast(hot), list(keys), "left").withColumn("_salt", salt)
    copied = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)))
    return salted.join(copied.drop(weight), [*keys, "_salt"], "left").drop("_salt", "_copies")


def attach_groups(
    left: DataFrame,
    groups: DataFrame,
    keys: Sequence[str],
    max_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left join with a table of one row per group, which is written out and counted first.

    A counted small table is broadcast. A larger one is joined by shuffle, with the groups that
    hold very many rows split.
    """
    side, rows = small_side(groups)
    if rows <= max_rows:
        return left.join(F.broadcast(side), list(keys), "left")
    weights = left.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_weight"))
    return lookup_join(left, side.join(weights, list(keys)), weights, keys, "_weight", hot_rows)
