"""Flat tables: the company universe and panels, as CSV or Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import schemas
from ledgerloom.functions.text import normal_cik
from ledgerloom.sources.stored import replace_folder


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV with a fixed schema; a byte-order mark is dropped, bad cells and NaN become NULL."""
    rows = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)
    numbers = [field.name for field in schema if isinstance(field.dataType, (T.DoubleType, T.FloatType))]
    return rows.withColumns({name: F.when(~F.isnan(name), F.col(name)) for name in numbers})


def read_universe(spark: SparkSession, path: str) -> DataFrame:
    """Universe rows in file order: ``row_id`` sorts as the lines of the file do."""
    rows = read_csv(spark, path, schemas.UNIVERSE)
    return rows.withColumn(
        "row_id",
        F.struct(
            F.col("_metadata.file_name").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        ),
    )


def read_panel(spark: SparkSession, path: str, schema: T.StructType = schemas.QUARTERLY_PANEL_WITH_RATIOS) -> DataFrame:
    """Panel CSV with its filer ids restored to ten digits."""
    return read_csv(spark, path, schema).withColumn("cik", normal_cik(F.col("cik")))


def write_csv(df: DataFrame, path: str, order: tuple[str, ...] = ()) -> None:
    """Header CSV; with ``order`` the files, one after the other, hold the rows sorted. Replaces a folder as a whole."""
    rows = df.orderBy(*order) if order else df
    replace_folder(df.sparkSession, path, lambda staged: rows.write.option("header", True).csv(staged))


def write_panel(
    df: DataFrame, path: str, by: tuple[str, ...] = ("fiscal_year",), order: tuple[str, ...] = ("ticker", "period_end")
) -> None:
    """Parquet, one folder per fiscal year, whose files follow each other in ``order``.

    Range partitions by year and order give few files a folder and split a year that holds many rows. A panel that
    is there already is replaced as a whole once the new one is complete.
    """
    keys = [*by, *[name for name in order if name in df.columns]]
    rows = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    replace_folder(df.sparkSession, path, lambda staged: rows.write.partitionBy(*by).parquet(staged))
