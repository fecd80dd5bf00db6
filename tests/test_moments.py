"""Moments that give the same bits for any order of rows, and profiles from footers."""

import numpy as np
import pandas as pd
import pytest

from ledgerloom.operators.moments import exact_moments
from ledgerloom.sources import documents, stored, tables


def test_moments_equal_pandas_and_do_not_depend_on_order(spark):
    rng = np.random.default_rng(7)
    frame = pd.DataFrame({
        "g": rng.choice(["a", "b", "c"], 5000, p=[0.9, 0.09, 0.01]), "x": rng.lognormal(10, 4, 5000), "y": 1e9 + rng.normal(0, 1e-3, 5000),
        "z": np.where(rng.random(5000) < 0.5, np.nan, rng.normal(0, 1, 5000)),
    })
    columns = ["x", "y", "z"]
    rows = []
    for seed, parts in ((1, 4), (2, 9)):
        df = spark.createDataFrame(frame.sample(frac=1, random_state=seed)).repartition(parts)
        rows.append(sorted(tuple(r) for r in exact_moments(df, columns, ["g"]).collect()))
        rows.append(sorted(tuple(r) for r in exact_moments(df, columns).collect()))
    assert rows[0] == rows[2] and rows[1] == rows[3]
    for values, group in [(rows[0][0][1:], frame[frame.g == "a"]), (rows[1][0], frame)]:
        assert list(values[:3]) == [int(group[c].count()) for c in columns]
        assert np.allclose(values[3:6], [group[c].mean() for c in columns], rtol=1e-13)
        assert np.allclose([values[6], values[8]], [group["x"].std(), group["z"].std()], rtol=1e-12)
        assert np.isclose(values[7], (group["y"] - 1e9).std(), rtol=1e-5)  # the digits a double has left beside 1e9


def test_few_equal_and_missing_values(spark):
    df = spark.createDataFrame(
        [("a", 5.0, None), ("b", 2.0, None), ("b", 2.0, float("nan")), ("c", 1.0, float("inf")), ("c", 3.0, 1.0), (None, 9.0, 1.0)], "g string, x double, y double"
    )
    got = {r.g: tuple(r)[1:7] for r in exact_moments(df, ["x", "y"], ["g"]).collect()}
    assert got == {"a": (1, 0, 5.0, None, None, None), "b": (2, 0, 2.0, None, 0.0, None), "c": (2, 2, 2.0, None, pytest.approx(2**0.5), None)}
    assert exact_moments(df.limit(0), ["x"], ["g"]).count() == 0
    assert tuple(exact_moments(df.limit(0), ["x"]).first()) == (0, None, None, None, None)


def test_profiles_come_from_footers(spark, tmp_path):
    path = str(tmp_path / "panel")
    rows = [("A", 2020, 1.0, None), ("B", 2021, None, 4), ("C", 2021, -7.5, 2)]
    tables.write_panel(spark.createDataFrame(rows, "ticker string, fiscal_year int, cash double, n int"), path)
    got = {tuple(r) for r in stored.footer_profile(spark, path, ["cash", "n"]).collect()}
    assert got == {("cash", 3, 2, -7.5, 1.0), ("n", 3, 2, 2.0, 4.0)}
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""


def test_the_plan_pushes_the_aggregation(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).write.parquet(path)
    old = spark.conf.get("spark.sql.sources.useV1SourceList")
    spark.conf.set("spark.sql.sources.useV1SourceList", "")
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    try:
        text = spark.read.parquet(path).agg({"id": "max"})._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.sources.useV1SourceList", old)
        spark.conf.set("spark.sql.parquet.aggregatePushdown", "false")
    assert "PushedAggregation: [MAX(id)]" in text


def test_unlisted_documents_are_not_opened(spark):
    docs = spark.createDataFrame([("A", {"us": 1}), ("B", {"us": 2})], "ticker string, doc map<string,int>")
    kept = documents.only_listed(docs, spark.createDataFrame([("B",), ("B",), (None,)], "ticker string")).selectExpr("ticker", "explode(doc)")
    text = kept._jdf.queryExecution().optimizedPlan().toString()
    assert kept.count() == 1 and text.index("Generate") < text.index("LeftSemi")  # the join lies below the generator
