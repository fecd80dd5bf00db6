"""From the ticker index and submission documents to the company list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import universe
from ledgerloom.sources import documents as docs


def categorised_companies(index: DataFrame, submissions: DataFrame) -> DataFrame:
    """The whole index with industry columns, defaults where no submission is known."""
    return universe.with_filer_lookup(index, docs.filer_categories(submissions))


def target_companies(
    categorised: DataFrame, submissions: DataFrame, sector: str | None = None, max_rows: int | None = None
) -> DataFrame:
    """Domestic annual filers with their profile."""
    profiled = universe.with_profiles(categorised, docs.filer_profiles(submissions))
    picked = universe.pick_sector(universe.domestic_filers(profiled), sector, max_rows)
    return picked.select(
        "ticker", "cik", "company", "sic_code", "sic_description", "target_sector",
        "state_of_incorporation", "country", "exchanges", "fiscal_year_end",
    )


def company_universe(spark: SparkSession, index_path: str, submissions_path: str) -> DataFrame:
    """All steps: categorise, keep domestic filers, one ticker per company, primary listings."""
    index = docs.read_ticker_index(spark, index_path)
    submissions = docs.read_submissions(spark, submissions_path, wanted=index)
    targets = target_companies(categorised_companies(index, submissions), submissions)
    research = universe.research_universe(targets)
    primary = universe.primary_listing(research)
    return universe.clean_universe(
        primary.withColumn("row_id", F.col("ticker")), order="row_id"
    )
