"""Facts documents of unknown shape, read as VARIANT values.

The fixed schema of ``documents`` turns what it does not expect into NULL, at worst a whole document. Here the text is
parsed once into a binary variant, and every level is opened as what it turns out to be: taxonomies, concepts and
units of any name come out, values that are no numbers survive as text, and a part of the wrong kind costs only itself.
A variant keeps the names of an object in alphabetical order, so ``unit_pos`` is that order and not the document's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import zero_fill

RECORDS = "array<struct<end string, val variant, form string, fp string, filed string>>"


def parse_variants(texts: DataFrame) -> DataFrame:
    """Add ``doc``; text that is not valid JSON, or names a key of one object twice, gives NULL."""
    return texts.select("*", F.explode_outer(F.array(F.try_parse_json("text"))).alias("doc"))


def _opened(df: DataFrame, value: Column, key: str, names: Sequence[str], nested: str) -> DataFrame:
    """One row per entry of a variant object: its name as ``key`` and its value as ``nested``."""
    spark = df.sparkSession
    entries = spark.tvf.variant_explode(value.outer())
    return df.lateralJoin(entries).select(*names, F.col("key").alias(key), F.col("value").alias(nested))


def flatten_variants(
    documents: DataFrame,
    tags: Sequence[str] | None = None,
    unit_preference: Sequence[str] | None = None,
) -> DataFrame:
    """Long facts like those of ``documents.flatten_facts``, from ``ticker`` and a variant ``doc``.

    ``raw_val`` is the JSON text of a value that is no number. With ``unit_preference`` each tag is read in the first
    listed unit that holds a list; without, every unit comes out with ``unit_pos``.
    """
    def text(value: str, path: str) -> Column:
        return F.try_variant_get(F.col(value), path, "string")

    head = documents.select(
        "ticker",
        zero_fill(F.coalesce(text("doc", "$.cik"), F.lit("")), 10).alias("cik"),
        F.coalesce(text("doc", "$.entityName"), F.lit("")).alias("company"),
        F.try_variant_get("doc", "$.facts", "variant").alias("facts"),
    )
    names = ["ticker", "cik", "company"]
    concepts = _opened(head, F.col("facts"), "taxonomy", names, "concepts")
    bodies = _opened(concepts, F.col("concepts"), "tag", [*names, "taxonomy"], "body")
    if tags is not None:
        bodies = bodies.where(F.col("tag").isin(*tags))
    names += ["taxonomy", "tag"]
    units = bodies.select(*names, F.try_variant_get("body", "$.units", "map<string, variant>").alias("units"))
    if unit_preference is None:
        listed = units.select(*names, "units", F.posexplode(F.sort_array(F.map_keys("units"))).alias("unit_pos", "unit"))
        listed = listed.select(*names, "unit_pos", "unit", F.try_element_at("units", F.col("unit")).alias("records"))
        names.append("unit_pos")
    else:
        choice = F.coalesce(*[F.when(_is_list(F.try_element_at("units", F.lit(u))), F.lit(u)) for u in unit_preference])
        chosen = units.withColumn("unit", choice).where(F.col("unit").isNotNull())
        listed = chosen.select(*names, "unit", F.try_element_at("units", F.col("unit")).alias("records"))
    # one walk over a list opens its records; a field of the wrong kind is NULL, as is a record that is no object
    records = listed.select(*names, "unit", F.posexplode(F.try_variant_get("records", "$", RECORDS)).alias("pos", "record"))
    raw = F.col("record.val")
    number = F.try_variant_get(raw, "$", "double")
    # a truth value reads as 0 or 1: only these are asked for their kind
    value = F.when(number.isNotNull() & (~number.isin(0.0, 1.0) | (F.schema_of_variant(raw) != "BOOLEAN")), number)
    return records.select(
        *names,
        "unit",
        "pos",
        F.col("record.end").try_cast("date").alias("period_end"),
        F.when(~F.isnan(value), value).alias("val"),
        F.col("record.form").alias("form"),
        F.col("record.fp").alias("fp"),
        F.col("record.filed").try_cast("date").alias("filed"),
        F.when(value.isNull() & ~F.is_variant_null(raw), F.to_json(raw)).alias("raw_val"),
    )


def _is_list(value: Column) -> Column:
    return F.schema_of_variant(value).startswith("ARRAY")
