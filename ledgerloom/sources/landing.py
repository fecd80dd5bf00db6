"""Which documents are still to fetch, and which belong to no company."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.documents import listed_files


def fetch_worklist(universe: DataFrame, landed: DataFrame, key: str = "ticker") -> DataFrame:
    """Companies without a landed document."""
    return universe.join(landed.select(key), key, "left_anti")


def orphans(landed: DataFrame, universe: DataFrame, key: str = "ticker") -> DataFrame:
    """Landed documents whose upper-cased ticker is in no universe row; listed, never deleted."""
    known = universe.select(F.upper(key).alias("_known")).distinct()
    return landed.join(known, F.upper(landed[key]) == known["_known"], "left_anti")


def landed_tickers(spark: SparkSession, path: str) -> DataFrame:
    """Tickers of the documents in a folder, from file names alone; no file is opened."""
    return listed_files(spark, path).select(F.regexp_replace("file_name", r"\.json$", "").alias("ticker"))
