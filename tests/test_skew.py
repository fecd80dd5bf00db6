"""Groups, keys and buckets that hold most of the rows."""

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from ledgerloom.operators import joins
from ledgerloom.operators.quantiles import exact_quantiles, melt, rows_below
from test_clean import to_spark


@pytest.mark.parametrize(("max_rows", "hot_rows"), [(10, 100), (0, 100), (0, 3)])
def test_group_join_is_whole_with_hot_and_null_keys(spark, max_rows, hot_rows):
    data = [(i, "hot" if i % 3 else None if i % 2 else f"k{i % 9}") for i in range(200)] + [(200, "unknown")]
    left = spark.createDataFrame(data, "id int, g string").repartition(5)
    groups = spark.createDataFrame([("hot", 1.0), ("k0", 2.0), ("k6", 3.0), ("unused", 4.0)], "g string, v double")
    value = {"hot": 1.0, "k0": 2.0, "k6": 3.0}
    got = joins.attach_groups(left, groups, ["g"], max_rows, hot_rows)
    assert rows(got.select("id", "g", "v"), "id") == [(i, g, value.get(g)) for i, g in data]


def narrow(size=6000):
    rng = np.random.default_rng(12)
    close = 1e6 + rng.integers(0, 3000, size) * 2.0**-20
    frame = pd.DataFrame({"g": np.where(rng.random(size) < 0.9, "big", "small"), "x": close})
    frame.loc[:50, "x"] = -close[:51]
    frame.loc[51:60, "x"] = 0.0
    return frame


def test_ranks_when_one_bucket_holds_nearly_everything(spark):
    frame = narrow()
    counts = melt(to_spark(spark, frame), ["x"], ["g"]).groupBy("g", "column", "value").agg(F.count("*").alias("rows"))
    got = rows_below(counts, ["g", "column"])
    for group, part in frame.groupby("g"):
        ranks = part["x"].rank(method="min")
        want = {(value, int(rank) - 1, len(part)) for value, rank in zip(part["x"], ranks)}
        found = got.where(F.col("g") == group).select("value", "below", "total")
        assert {tuple(r) for r in found.collect()} == want


def test_quantiles_when_one_bucket_holds_nearly_everything(spark):
    frame = narrow()
    for row in exact_quantiles(to_spark(spark, frame), ["x"], {"a": 0.005, "b": 0.5, "c": 0.99}, ["g"]).collect():
        part = frame.loc[frame["g"] == row["g"], "x"]
        assert [row["a"], row["b"], row["c"]] == pytest.approx(list(part.quantile([0.005, 0.5, 0.99])), rel=1e-12)
