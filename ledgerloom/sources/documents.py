"""JSON documents, one per file: company facts, submissions and the ticker index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import schemas
from ledgerloom.functions.text import (
    bare_cik,
    first_or_blank,
    join_present,
    lists_item,
    nested_text,
    zero_fill,
)
from ledgerloom.rules import sector_of_sic
from ledgerloom.session import BROADCAST_ROWS, small_side
from ledgerloom.sources.stored import replace_folder


def read_texts(spark: SparkSession, path: str, glob: str = "*.json", names: Sequence[str] | None = None) -> DataFrame:
    """One row per file: ``file_name`` and the whole ``text``.

    With ``names`` only these files are read: a filter on the file's name is settled on the list of files, before
    any file is opened.
    """
    files = spark.read.option("pathGlobFilter", glob).text(path, wholetext=True)
    if names is not None:
        files = files.where(F.col("_metadata.file_name").isin(*names) if names else F.lit(False))
    return files.select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("text"))


def listed_files(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """``file_name`` and ``length`` of every file; no file is opened, because the content is not asked for."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"), "length")


def wanted_files(files: DataFrame, key: Column, wanted: DataFrame, on: Column) -> list[str]:
    """Names of the files whose ``key`` is among the wanted rows' ``on``.

    The names come to the driver, which already holds every one of them in its list of the folder.
    """
    keyed = files.select("file_name", key.alias("_key")).where(F.col("_key") != "")
    found = keyed.join(wanted.select(on.alias("_key")).distinct(), "_key", "left_semi")
    return sorted(row["file_name"] for row in found.select("file_name").collect())


def parse_texts(texts: DataFrame, schema: T.DataType) -> DataFrame:
    """Add ``doc``; text that is not valid JSON gives a document of NULLs.

    Parsing is the costly part, so it sits in a generator: filters on ``doc`` cannot be pushed
    below it and parse the text a second time.
    """
    parsed = F.from_json("text", schema, {"mode": "PERMISSIVE"})
    return texts.select("*", F.explode_outer(F.array(parsed)).alias("doc"))


def read_fact_documents(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """Ticker (the file stem) and parsed document, readable or not.

    ``wanted`` (a frame with ``ticker``) leaves the files of other companies unread.
    """
    stem = F.regexp_replace("file_name", r"\.json$", "")
    names = None if wanted is None else wanted_files(listed_files(spark, path), stem, wanted, F.col("ticker"))
    parsed = parse_texts(read_texts(spark, path, names=names), schemas.FACTS_DOCUMENT)
    return parsed.select(stem.alias("ticker"), "doc")


def rejected_documents(documents: DataFrame) -> DataFrame:
    """Tickers whose document is corrupt or carries no facts."""
    return documents.where(F.col("doc.facts").isNull()).select("ticker")


def only_listed(documents: DataFrame, listed: DataFrame, key: str = "ticker") -> DataFrame:
    """Documents of listed companies; the others go before any of their facts is opened.

    The list is broadcast when it was counted to be small; otherwise whole documents meet it by shuffle, still one
    row a company.
    """
    side, rows = small_side(listed.select(key).distinct())
    return documents.join(F.broadcast(side) if rows <= BROADCAST_ROWS else side, key, "left_semi")


def _unit_choice(units: Column, preference: tuple[str, ...], any_unit: bool) -> Column:
    listed = [F.when(F.map_contains_key(units, unit), F.lit(unit)) for unit in preference]
    fallback = [F.get(F.map_keys(units), F.lit(0))] if any_unit else []
    return F.coalesce(*listed, *fallback)


def flatten_facts(
    documents: DataFrame,
    tags: list[str] | None = None,
    unit_preference: tuple[str, ...] | None = None,
    any_unit: bool = False,
) -> DataFrame:
    """Long facts: one row per reported value, with its position in the document's list.

    ``tags`` keeps only those concepts before anything is exploded. With ``unit_preference`` each
    tag is read in the first listed unit it has at all (``any_unit``: else in its first one);
    without, every unit comes out and a column ``unit_pos`` keeps the document's unit order.
    """
    head = [
        F.col("ticker"),
        zero_fill(F.coalesce(F.col("doc.cik"), F.lit("")), 10).alias("cik"),
        F.coalesce(F.col("doc.entityName"), F.lit("")).alias("company"),
    ]
    by_taxonomy = documents.select(*head, F.explode("doc.facts").alias("taxonomy", "concepts"))
    concepts = F.col("concepts")
    if tags is not None:
        concepts = F.map_filter(concepts, lambda tag, _: tag.isin(tags))
    by_tag = by_taxonomy.select(
        "ticker", "cik", "company", "taxonomy", F.explode(concepts).alias("tag", "body")
    )
    keys = ["ticker", "cik", "company", "taxonomy", "tag"]
    units = F.col("body.units")
    if unit_preference is None:
        by_unit = by_tag.select(*keys, F.posexplode(F.map_entries(units)).alias("unit_pos", "entry")).select(
            *keys, "unit_pos", F.col("entry.key").alias("unit"), F.col("entry.value").alias("records")
        )
    else:
        chosen = by_tag.withColumn("unit", _unit_choice(units, unit_preference, any_unit))
        by_unit = chosen.where(F.col("unit").isNotNull()).select(
            *keys, "unit", F.try_element_at(units, F.col("unit")).alias("records")
        )
    place = ["unit_pos"] if unit_preference is None else []
    records = by_unit.select(*keys, "unit", *place, F.posexplode("records").alias("pos", "record"))
    value = F.col("record.val")
    return records.select(
        *keys,
        "unit",
        *place,
        "pos",
        F.col("record.end").try_cast("date").alias("period_end"),
        F.when(~F.isnan(value), value).alias("val"),
        F.col("record.form").alias("form"),
        F.col("record.fp").alias("fp"),
        F.col("record.filed").try_cast("date").alias("filed"),
    )


def write_long_facts(facts: DataFrame, path: str) -> None:
    """Land the long facts as Parquet, one folder per taxonomy, sorted by company inside files."""
    rows = facts.sortWithinPartitions("taxonomy", "ticker", "tag")
    replace_folder(facts.sparkSession, path, lambda staged: rows.write.partitionBy("taxonomy").parquet(staged))


def ticker_index(texts: DataFrame) -> DataFrame:
    """Ticker, ten-digit cik and company from index documents."""
    parsed = texts.select(F.from_json("text", schemas.TICKER_INDEX).alias("index"))
    entries = parsed.select(F.explode(F.map_values("index")).alias("entry"))
    return entries.select(
        F.col("entry.ticker").alias("ticker"),
        zero_fill(F.col("entry.cik_str").cast("string"), 10).alias("cik"),
        F.col("entry.title").alias("company"),
    )


def read_ticker_index(spark: SparkSession, path: str) -> DataFrame:
    return ticker_index(read_texts(spark, path))


def read_submissions(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """Submission documents by ``cik_key`` (id without leading zeros).

    Only files named exactly CIK<digits>.json count. With ``wanted`` (a frame with ``cik``) the names are
    compared first, and the files of other filers are never opened.
    """
    key = F.regexp_extract("file_name", r"^CIK0*(\d+)\.json$", 1)
    names = None
    if wanted is not None:
        names = wanted_files(listed_files(spark, path, "CIK*.json"), key, wanted, bare_cik(F.col("cik")))
    keyed = read_texts(spark, path, "CIK*.json", names).withColumn("cik_key", key)
    parsed = parse_texts(keyed.where(F.col("cik_key") != ""), schemas.SUBMISSION_DOCUMENT)
    # A corrupt file parses to nothing but NULLs and is skipped.
    names = [field.name for field in schemas.SUBMISSION_DOCUMENT]
    readable = F.exists(F.array(*[F.col(f"doc.{name}").isNotNull() for name in names]), lambda there: there)
    return parsed.where(readable).select("cik_key", "doc")


def filer_categories(submissions: DataFrame) -> DataFrame:
    """Name, first ticker and industry of every filer, from the documents alone."""
    return submissions.select(
        first_or_blank(F.col("doc.tickers")).alias("ticker"),
        zero_fill(F.col("cik_key"), 10).alias("cik"),
        nested_text("doc.name").alias("company"),
        nested_text("doc.sic").alias("sic_code"),
        nested_text("doc.sicDescription", "Unknown").alias("sic_description"),
        sector_of_sic(F.col("doc.sic")).alias("target_sector"),
    )


def filer_profiles(submissions: DataFrame) -> DataFrame:
    """What a filer is and which forms it files."""
    forms = F.col("doc.filings.recent.form")
    return submissions.select(
        "cik_key",
        nested_text("doc.entityType").alias("entity_type"),
        nested_text("doc.stateOfIncorporation").alias("state_of_incorporation"),
        nested_text("doc.addresses.business.stateOrCountryDescription").alias("country"),
        join_present(F.col("doc.exchanges")).alias("exchanges"),
        lists_item(forms, "10-K").alias("files_10k"),
        (lists_item(forms, "20-F") | lists_item(forms, "40-F")).alias("files_20f_or_40f"),
        nested_text("doc.fiscalYearEnd").alias("fiscal_year_end"),
    )
