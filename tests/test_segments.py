"""Series that fill many partitions, against pandas and against windows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import segments


def frame(size, hot, seed):
    """A series that holds ``hot`` of all rows, rows without a series, and long gaps."""
    rng = np.random.default_rng(seed)
    names = np.where(rng.random(size) < hot, "hot", rng.choice(["a", "b", "c", "d", "none"], size))
    return pd.DataFrame({
        "ticker": [None if n == "none" else n for n in names], "at": rng.permutation(size),
        "x": np.where(rng.random(size) < 0.9, np.nan, rng.normal(0, 1, size).round(3)), "y": np.where(rng.random(size) < 0.3, np.nan, np.arange(size) * 1.0),
    })


def to_spark(spark, data):
    return spark.createDataFrame(data.astype(object).where(data.notna(), None).values.tolist(), "ticker string, at long, x double, y double")


def found(df, names):
    got = df.toPandas().sort_values("at").reset_index(drop=True)
    return got[["at", *names]].astype(float)


@pytest.mark.parametrize("size, hot, parts", [(400, 0.7, 8), (60, 0.5, 25), (30, 1.0, 29), (5, 0.0, 8)])
def test_long_series_equal_pandas(spark, size, hot, parts):
    data = frame(size, hot, size)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = to_spark(spark, data)
        filled = found(segments.forward_fill_long(df, ["x", "y"], ["ticker"], ["at"]), ["x", "y"])
        lags = {"x1": ("x", 1), "y1": ("y", 1), "y3": ("y", 3), "y7": ("y", 7)}
        lagged = found(segments.lag_long(df, lags, ["ticker"], ["at"]), list(lags))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    ordered = data.sort_values("at").reset_index(drop=True)
    groups = ordered.groupby("ticker", dropna=False)
    for name in ("x", "y"):
        assert np.allclose(filled[name], groups[name].ffill().astype(float), equal_nan=True)
    for new, (name, back) in lags.items():
        assert np.allclose(lagged[new], groups[name].shift(back).astype(float), equal_nan=True)


def test_a_hot_series_fills_several_tasks(spark):
    df = spark.range(20_000).select(F.lit("hot").alias("ticker"), "id", F.when(F.col("id") % 500 == 0, F.col("id")).alias("x"))
    filled = segments.forward_fill_long(df, ["x"], ["ticker"], ["id"])
    sizes = [r["count"] for r in segments._sorted(df, ["ticker"], ["id"]).groupBy("_part").count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 10_000
    assert filled.where("x <> id - id % 500 or x is null").count() == 0 and filled.count() == 20_000


def test_empty_tables(spark):
    df = spark.createDataFrame([], "ticker string, at long, x double")
    assert segments.forward_fill_long(df, ["x"], ["ticker"], ["at"]).count() == 0
    assert segments.lag_long(df, {"x1": ("x", 1)}, ["ticker"], ["at"]).count() == 0
