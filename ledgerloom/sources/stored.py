"""Stored tables: folders replaced as a whole, and bucketed tables whose layout the planner knows.

What is written goes beside what is there and takes its place only when it is complete, so a job that fails or loses its
driver leaves the old data readable. Bucketed tables keep the rows of a key in one bucket: joins, windows and
aggregations on the key then read them without a shuffle.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import shared_folder

BUCKET_ROWS = 250_000


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder, jvm


def delete_folder(spark: SparkSession, path: str) -> None:
    system, folder, _ = _file_system(spark, path)
    system.delete(folder, True)


def replace_folder(spark: SparkSession, target: str, write: Callable[[str], None]) -> None:
    """Let ``write`` fill a new folder beside ``target``, then put it in its place.

    The old folder goes only when the new one stands; if the move fails, the old one comes back. On a file system
    with atomic renames readers see the old or the new folder, or for a moment between two renames none.
    """
    mark = uuid.uuid4().hex
    staged, aside = f"{target.rstrip('/')}.new-{mark}", f"{target.rstrip('/')}.old-{mark}"
    system, folder, jvm = _file_system(spark, target)
    path = jvm.org.apache.hadoop.fs.Path
    try:
        write(staged)
        there = system.exists(folder)
        if there and not system.rename(folder, path(aside)):
            raise OSError(f"{target} cannot be moved aside")
        if not system.rename(path(staged), folder):
            if there:
                system.rename(path(aside), folder)
            raise OSError(f"{target} cannot be replaced")
    finally:
        system.delete(path(staged), True)
    system.delete(path(aside), True)


def footer_profile(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """(column, rows, present, least, greatest) of number columns of a stored table, from its file footers.

    The newer reader answers counts, minima and maxima from the statistics of the row groups, so that no data page is read.
    Row groups without a value of a column have no extremes; where there are such, the extremes come from a scan.
    The answers are single rows, fetched while the two settings they need are in force.
    """
    wanted = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
    before = {name: spark.conf.get(name) for name in wanted}
    counts = [F.count(F.lit(1)).alias("rows"), *[F.count(name).alias(f"{name}__n") for name in columns]]
    ends = [end(name).alias(f"{name}__{label}") for name in columns for label, end in (("low", F.min), ("high", F.max))]
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        row = spark.read.parquet(path).agg(*counts).first().asDict()
        try:
            row |= spark.read.parquet(path).agg(*ends).first().asDict()
        except Exception as error:
            if "No min/max found" not in str(error):
                raise
            spark.conf.set("spark.sql.parquet.aggregatePushdown", "false")
            row |= spark.read.parquet(path).agg(*ends).first().asDict()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)

    def number(value) -> float | None:
        return None if value is None else float(value)

    cells = [(n, row["rows"], row[f"{n}__n"], number(row[f"{n}__low"]), number(row[f"{n}__high"])) for n in columns]
    return spark.createDataFrame(cells, "column string, rows long, present long, least double, greatest double")


def bucket_count(rows: int, least: int = 8) -> int:
    """Buckets for a table of so many rows: each stays small enough for one task, however many there are."""
    return max(least, -(-rows // BUCKET_ROWS))


def store_bucketed(
    df: DataFrame, name: str, keys: Sequence[str], buckets: int, sort: Sequence[str] = (), placed: bool = False
) -> None:
    """Save ``df`` as a new version of the bucketed table ``name``; a view of that name moves to it at the end.

    One sorted file a bucket. ``placed`` says that the rows already lie in ``buckets`` partitions by the keys, as they
    do after a join with a table of these buckets; otherwise one shuffle puts them there.
    """
    spark = df.sparkSession
    version = f"{name}_{uuid.uuid4().hex}"
    rows = df if placed else df.repartition(buckets, *keys)
    writer = rows.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys, *sort)
    writer.option("path", f"{shared_folder(spark)}/stored/{version}").saveAsTable(version)
    before = versions(spark, name)
    spark.sql(f"create or replace view {name} as select * from {version}")
    for old in before:
        if old != version:
            _drop_version(spark, old)


def versions(spark: SparkSession, name: str) -> list[str]:
    return [t.name for t in spark.catalog.listTables() if not t.isTemporary and t.name.startswith(f"{name}_") and len(t.name) == len(name) + 33]


def _drop_version(spark: SparkSession, version: str) -> None:
    spark.sql(f"drop table if exists {version}")
    delete_folder(spark, f"{shared_folder(spark)}/stored/{version}")


def drop_stored(spark: SparkSession, name: str) -> None:
    """Remove a bucketed table with all its versions."""
    spark.sql(f"drop view if exists {name}")
    for version in versions(spark, name):
        _drop_version(spark, version)
