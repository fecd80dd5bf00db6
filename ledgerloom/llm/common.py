"""What the operators of this subpackage share: written intermediates, code shipping, group streams."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import cut_lineage

_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Give the executors this package, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="code-")
    staged = os.path.join(folder, "src")
    shutil.copytree(package, os.path.join(staged, os.path.basename(package)), ignore=shutil.ignore_patterns("__pycache__"))
    spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(folder, "ledgerloom_code"), "zip", staged))
    _shipped.add(app)


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder: computed once, safe against lost executors."""
    return cut_lineage(df)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` is called so."""
    taken = {x.lower() for x in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def parts(spark: SparkSession) -> int:
    """The session's number of shuffle partitions; it is what a user raises with the input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def grouped(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a key in one partition, next to each other."""
    return df.repartition(parts(df.sparkSession), *keys).sortWithinPartitions(*keys)


def key_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole groups of a partition sorted by integer ``keys``: tables of some groups, with the group offsets.

    Only the rows of groups that are not complete yet wait in memory.
    """
    waiting: list[pa.Table] = []
    for batch in batches:
        if batch.num_rows:
            rows = pa.Table.from_batches([batch])
            starts = _starts(rows, keys)
            if len(starts) > 1 or (waiting and not _same(waiting[-1], rows, keys)):
                cut = starts[-1] if len(starts) > 1 else 0
                done = pa.concat_tables([*waiting, rows.slice(0, cut)])
                waiting = [rows.slice(cut)]
                yield done, np.append(_starts(done, keys), done.num_rows)
            else:
                waiting.append(rows)
    if waiting:
        done = pa.concat_tables(waiting)
        yield done, np.append(_starts(done, keys), done.num_rows)


def _starts(rows: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(rows.num_rows, bool)
    new[:1] = True
    for key in keys:
        values = rows[key].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _same(before: pa.Table, after: pa.Table, keys: list[str]) -> bool:
    return all(before[k][before.num_rows - 1].as_py() == after[k][0].as_py() for k in keys)


def crc_fold(column: str = "doc_id", folds: int = 5) -> F.Column:
    """crc32 of an id's text modulo ``folds``; NULL ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % folds
