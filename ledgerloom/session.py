"""Session settings and the two helpers that touch cluster state."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}

# A side may be broadcast only after it was counted to hold at most this many rows.
BROADCAST_ROWS = 200_000


def build_session(app: str = "ledgerloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the checkpoint folder the session names; only a local master may fall back to /tmp."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        context.setCheckpointDir(configured)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerloom-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share."""
    ensure_checkpoint_dir(spark)
    return spark.sparkContext.getCheckpointDir()


_scopes: list[list[str]] = []


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that ``cut_lineage`` wrote inside, once the block's own results are written.

    Frames made inside must not be read after it. Blocks may be nested; each deletes its own tables.
    """
    written: list[str] = []
    _scopes.append(written)
    try:
        yield
    finally:
        _scopes.remove(written)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for name in written:
            folder = path(name)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and go on from the written table.

    Parquet rather than ``checkpoint()``: later passes read only the columns they need.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame) -> tuple[DataFrame, int]:
    """Write a join side out and say how many rows it has, so that it is broadcast only if small."""
    seen = Observation()
    written = cut_lineage(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return written, seen.get["rows"]
