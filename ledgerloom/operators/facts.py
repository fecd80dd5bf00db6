"""From reported values to one value per field and period.

Every step first aggregates to its grain, so a filer that holds a large share of all facts is
already reduced on the map side; windows only run over what is left, which is bounded by
(tags or units) x (distinct dates) of one filer.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import rules


def accepted(facts: DataFrame, forms: Sequence[str], min_year: int | None = None) -> DataFrame:
    """Facts from accepted forms that have both a period and a value."""
    kept = facts.where(
        F.col("form").isin(*forms) & F.col("period_end").isNotNull() & F.col("val").isNotNull()
    )
    return kept if min_year is None else kept.where(F.year("period_end") >= min_year)


def with_calendar(df: DataFrame, period: str = "period_end") -> DataFrame:
    """Calendar year and quarter of the period end, under their customary fiscal names."""
    return df.withColumns(
        {
            "fiscal_year": F.year(period).cast("int"),
            "fiscal_quarter": F.quarter(period).cast("int"),
        }
    )


def reported_quarter(
    code: Column, period: Column, codes: Mapping[str, int] = rules.FISCAL_QUARTERS
) -> Column:
    """Quarter from the filing's period code, else the calendar quarter."""
    named = F.lit(None).cast("int")
    for name, quarter in codes.items():
        named = F.when(code == name, F.lit(quarter)).otherwise(named)
    return F.coalesce(named, F.quarter(period).cast("int"))


def with_fields(facts: DataFrame, tag_rules: DataFrame, on: Sequence[str] = ("taxonomy", "tag")) -> DataFrame:
    """Attach the fields a tag may feed. The rules are a fixed list, so they are broadcast."""
    return facts.join(F.broadcast(tag_rules), list(on))


def latest_filing(
    facts: DataFrame,
    keys: Sequence[str],
    carry: Sequence[str],
    filed: str = "filed",
    position: Sequence[str] = ("pos",),
    lead: str | None = None,
    where: Column | None = None,
) -> DataFrame:
    """The filing that counts for every key: latest ``filed``, earliest position among equals.

    A first record without a filing date is never replaced. A ``lead`` column (a tag priority)
    is compared before anything else. With ``where`` only matching rows compete, and keys with
    no match come out with NULLs. One integer ``position``, unique within a key, is compared in
    hash tables; several columns are compared as structs.
    """
    payload = list(dict.fromkeys([*([lead] if lead else []), filed, *carry]))
    matches = F.lit(True) if where is None else where
    if len(position) == 1 and isinstance(facts.schema[position[0]].dataType, (T.IntegerType, T.LongType)):
        picked = _by_packed_order(facts, keys, payload, filed, position[0], lead, matches)
    else:
        picked = _by_struct_order(facts, keys, payload, filed, position, lead, matches)
    undated = F.col(f"_first.{filed}").isNull()
    record = F.when(undated, F.col("_first")).otherwise(F.col("_newest"))
    return picked.withColumn("_record", record).select(*keys, "_record.*")


def packed_order(filed: str, position: str, lead: str | None = None) -> tuple[Column, Column]:
    """One number each by which the first record is the least and the newest the greatest.

    Digits from the top: 10 for the lead (reversed), 8 for the filing day, 19 for the position
    (reversed). Positions are unique within a key, so all columns come from the same record.
    """
    def digits(value: Column, shift: int) -> Column:
        return value.cast("decimal(19,0)") * F.lit(Decimal(10) ** shift).cast(f"decimal({shift + 1},0)")

    rank = F.lit(0) if lead is None else F.col(lead)
    place = F.col(position).cast("decimal(20,0)")
    day = F.unix_date(filed).cast("long") + (1 << 23)
    newest = digits(F.lit(10**10 - 1) - rank.cast("long"), 27) + digits(day, 19) + (F.lit(Decimal(10) ** 19 - 1) - place)
    first = digits(rank, 19) + place
    return first.cast("decimal(38,0)"), newest.cast("decimal(38,0)")


def _by_packed_order(facts, keys, payload, filed, position, lead, matches) -> DataFrame:
    """First and newest record by one number each, which keeps the aggregation in hash tables."""
    by_first, by_newest = [F.when(matches, rank) for rank in packed_order(filed, position, lead)]
    grouped = facts.groupBy(*keys).agg(
        *[F.min_by(name, by_first).alias(f"_first_{name}") for name in payload],
        *[F.max_by(name, by_newest).alias(f"_newest_{name}") for name in payload],
    )
    return grouped.select(
        *keys,
        *[
            F.struct(*[F.col(f"{side}_{name}").alias(name) for name in payload]).alias(side)
            for side in ("_first", "_newest")
        ],
    )


def _by_struct_order(facts, keys, payload, filed, position, lead, matches) -> DataFrame:
    """The same for positions of several columns, by comparing structs."""
    ahead = [F.col(lead)] if lead else []
    place = [F.col(name) for name in position]
    record = F.struct(*[F.col(name) for name in payload]).alias("record")
    age = (-F.unix_date(filed)).alias("age")
    first = F.when(matches, F.struct(*ahead, *place, record))
    newest = F.when(matches & F.col(filed).isNotNull(), F.struct(*ahead, age, *place, record))
    grouped = facts.groupBy(*keys).agg(F.min(first).alias("_f"), F.min(newest).alias("_n"))
    return grouped.select(*keys, F.col("_f.record").alias("_first"), F.col("_n.record").alias("_newest"))


def unit_rank(unit: Column, preference: Sequence[str], position: Column | None = None) -> Column:
    """Rank of a unit in the preference; other units follow in ``position`` order or get NULL."""
    rank = F.lit(None).cast("int") if position is None else F.lit(len(preference)) + position
    for place, name in reversed(list(enumerate(preference))):
        rank = F.when(unit == name, F.lit(place)).otherwise(rank)
    return rank


def latest_in_preferred_unit(
    facts: DataFrame,
    keys: Sequence[str],
    period: str,
    rank: Column,
    where: Column,
    carry: Sequence[str],
    filed: str = "filed",
    position: Sequence[str] = ("pos",),
) -> DataFrame:
    """Latest filing per key and period, read in the best unit the key has at all.

    The unit is chosen before ``where`` is looked at: a key whose best unit has no acceptable
    row yields nothing, even when another unit would.
    """
    ranked = facts.withColumn("_unit", rank).where(F.col("_unit").isNotNull())
    reduced = latest_filing(
        ranked.withColumn("_hit", F.lit(True)),
        [*keys, period, "_unit"],
        [*carry, "_hit"],
        filed,
        position,
        where=where,
    )
    best = F.min("_unit").over(Window.partitionBy(*keys))
    return reduced.withColumn("_best", best).where(
        (F.col("_unit") == F.col("_best")) & F.col("_hit")
    ).drop("_unit", "_best", "_hit")


def resolve_by_period(
    tagged: DataFrame,
    entity: Sequence[str],
    period: str = "period_end",
    value: str = "val",
    filed: str = "filed",
    position: Sequence[str] = ("pos",),
) -> DataFrame:
    """Latest filing and best available tag per field and period, in one aggregation."""
    keys = [*entity, "statement", "field", "field_order", period]
    return latest_filing(tagged, keys, [value], filed, position, lead="priority")


def resolve_by_entity(
    tagged: DataFrame,
    entity: Sequence[str],
    year: str = "fiscal_year",
    period: str = "period_end",
    value: str = "val",
    filed: str = "filed",
    position: Sequence[str] = ("pos",),
) -> DataFrame:
    """Latest filing per field and year; one tag supplies all years of a company's field.

    The yearly values, at most one per tag and year, come out partitioned by company, so what
    is computed per company from here on needs no further shuffle.
    """
    keys = [*entity, "statement", "field", "field_order", "priority", year]
    yearly = latest_filing(tagged, keys, [value, period], filed, position).repartition(*entity)
    best = F.min("priority").over(Window.partitionBy(*entity, "field"))
    return yearly.withColumn("_best", best).where(F.col("priority") == F.col("_best")).drop("_best")
