"""The latest filing per key as a state that takes in new filings batch by batch.

A state has one row per key: the first record by position and the newest by filing date, each with the number it was
chosen by. Both choices are minima or maxima of such numbers, so states merge in any order, a batch may come twice, and
the state after all batches equals one fold over everything. Kept as a bucketed table, a day's merge shuffles
the day's filings and not the history.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.facts import packed_order
from ledgerloom.sources.stored import drop_stored, store_bucketed

SIDES = ("first", "newest")


def _payload(carry: Sequence[str], filed: str, lead: str | None) -> list[str]:
    return list(dict.fromkeys([*([lead] if lead else []), filed, *carry]))


def fold(
    facts: DataFrame, keys: Sequence[str], carry: Sequence[str], filed: str = "filed", position: str = "pos", lead: str | None = None
) -> DataFrame:
    """The state of some facts: keys, and for each side its rank and payload. Rows with a NULL key are left out.

    Positions are integers, unique within a key over all batches, as for ``latest_filing``.
    """
    by_first, by_newest = packed_order(filed, position, lead)
    payload = _payload(carry, filed, lead)
    known = facts.dropna(subset=list(keys))
    return known.groupBy(*keys).agg(
        F.min(by_first).alias("first_rank"),
        F.max(by_newest).alias("newest_rank"),
        *[F.min_by(name, by_first).alias(f"first_{name}") for name in payload],
        *[F.max_by(name, by_newest).alias(f"newest_{name}") for name in payload],
    )


def merged(state: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Two states of disjoint or overlapping facts as one."""
    same = reduce(lambda a, b: a & b, [F.col(f"s.{key}") == F.col(f"b.{key}") for key in keys])
    both = state.alias("s").join(batch.alias("b"), same, "full")

    def chosen(name: str) -> Column:
        side = name.split("_")[0]
        ours, theirs = F.col(f"s.{side}_rank"), F.col(f"b.{side}_rank")
        better = theirs < ours if side == "first" else theirs > ours
        return F.when(ours.isNull() | better, F.col(f"b.{name}")).otherwise(F.col(f"s.{name}")).alias(name)

    rest = [name for name in state.columns if name not in keys]
    return both.select(*[F.coalesce(f"s.{key}", f"b.{key}").alias(key) for key in keys], *[chosen(name) for name in rest])


def latest_of_fold(
    state: DataFrame, keys: Sequence[str], carry: Sequence[str], filed: str = "filed", lead: str | None = None
) -> DataFrame:
    """What ``latest_filing`` gives for the folded facts: a first record without a filing date stands."""
    undated = F.col(f"first_{filed}").isNull()
    names = _payload(carry, filed, lead)
    return state.select(*keys, *[F.when(undated, F.col(f"first_{n}")).otherwise(F.col(f"newest_{n}")).alias(n) for n in names])


class FoldTable:
    """A state kept as a bucketed table ``name``; every merge writes a new version and then moves to it."""

    def __init__(
        self, spark: SparkSession, name: str, keys: Sequence[str], carry: Sequence[str], buckets: int,
        filed: str = "filed", position: str = "pos", lead: str | None = None,
    ):
        self.spark, self.name, self.buckets = spark, name, buckets
        self.keys, self.carry, self.filed, self.position, self.lead = list(keys), list(carry), filed, position, lead

    def merge(self, facts: DataFrame) -> None:
        """Take in a batch; taking it in again changes nothing."""
        batch = fold(facts, self.keys, self.carry, self.filed, self.position, self.lead)
        if self.spark.catalog.tableExists(self.name):
            store_bucketed(self.joined(batch), self.name, self.keys, self.buckets, placed=True)
        else:
            store_bucketed(batch, self.name, self.keys, self.buckets)

    def joined(self, batch: DataFrame) -> DataFrame:
        # the state decides the partitions, as it is larger: its buckets are read as they lie
        placed = batch.repartition(self.buckets, *self.keys)
        return merged(self.spark.table(self.name).hint("merge"), placed, self.keys)

    def latest(self) -> DataFrame:
        return latest_of_fold(self.spark.table(self.name), self.keys, self.carry, self.filed, self.lead)

    def drop(self) -> None:
        drop_stored(self.spark, self.name)
