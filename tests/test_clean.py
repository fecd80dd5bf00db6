"""Cleaning steps against hand-made rows and against pandas."""

import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from ledgerloom.operators import clean, dedupe, features, quality
from ledgerloom.operators.quantiles import exact_quantiles
from ledgerloom.plans.cleaning import clean_panel

D = dt.date


def to_spark(spark, frame):
    """Spark frame with NULL for every missing cell."""
    records = [tuple(None if v is None or (isinstance(v, float) and math.isnan(v)) else v for v in row)
               for row in frame.itertuples(index=False)]
    kinds = {"f": "double", "i": "int", "b": "boolean", "O": "string"}
    names = [f"{c} {'date' if c in ('period_end', 'filing_date') else kinds[frame[c].dtype.kind]}" for c in frame.columns]
    return spark.createDataFrame(records, ", ".join(names))


def random_panel(seed=5, tickers=12, quarters=20):
    rng = random.Random(seed)
    ends = [d.date() for d in pd.date_range("2015-03-31", periods=quarters, freq="QE")]
    names = ["revenue", "net_income", "total_assets", "equity", "current_assets", "cash", "total_liabilities"]
    data = []
    for t in range(tickers):
        for end in ends:
            if rng.random() < 0.15:
                continue
            cells = [rng.choice([None, 0.0, round(rng.gauss(1e4, 2e4), 2), round(rng.gauss(100, 900), 2)]) for _ in names]
            data.append((f"T{t}", end, end.year, (end.month - 1) // 3 + 1, *cells))
    frame = pd.DataFrame(data, columns=["ticker", "period_end", "fiscal_year", "fiscal_quarter", *names])
    frame[names] = frame[names].astype(float)
    return frame, names


def assert_same(df, frame, keys):
    """Spark result equals the pandas frame, NULL matching NaN."""
    got = df.orderBy(*keys).toPandas()[list(frame.columns)]
    want = frame.sort_values(keys).reset_index(drop=True)
    for name in frame.columns:
        if want[name].dtype.kind == "f":
            np.testing.assert_allclose(got[name].astype(float), want[name], rtol=1e-9, atol=1e-9, err_msg=name)
        else:
            assert list(got[name]) == list(want[name]), name


def test_forward_fill_lag_and_growth_match_pandas(spark):
    frame, names = random_panel()
    df = to_spark(spark, frame)
    filled = frame.sort_values(["ticker", "period_end"]).reset_index(drop=True)
    stock = ["total_assets", "equity", "current_assets", "cash", "total_liabilities"]
    filled[stock] = filled.groupby("ticker")[stock].ffill()
    assert_same(clean.forward_fill(df), filled, ["ticker", "period_end"])

    grown = filled.copy()
    for name in ("revenue", "net_income", "total_assets", "equity"):
        lag = grown.groupby("ticker")[name].shift(1)
        grown[f"{name}_lag1"] = lag
        change = (grown[name] - lag) / lag.abs()
        grown[f"{name}_growth_qoq"] = change.where(lag.fillna(0) != 0).round(4)
    got = features.with_growth(features.with_lags(clean.forward_fill(df)))
    assert_same(got, grown, ["ticker", "period_end"])


def test_missing_period_sorts_last(spark):
    data = [("A", D(2020, 3, 31), 1.0), ("A", None, None), ("A", D(2020, 6, 30), 2.0), ("B", D(2020, 3, 31), None)]
    df = spark.createDataFrame(data, "ticker string, period_end date, cash double")
    got = clean.forward_fill(df)
    assert rows(got.where("period_end is null").select("cash")) == [(2.0,)]
    assert rows(got.where("ticker = 'B'").select("cash")) == [(None,)]


def test_median_fill_matches_pandas_and_empties_rows_without_a_year(spark):
    frame, _ = random_panel(7)
    want = frame.copy()
    for name in ("total_assets", "cash"):
        want[name] = want.groupby("fiscal_year")[name].transform(lambda s: s.fillna(s.median()))
    got = clean.fill_group_median(to_spark(spark, frame), ["total_assets", "cash"])
    assert_same(got, want, ["ticker", "period_end"])
    odd = spark.createDataFrame([(None, 5.0), (2020, 1.0), (2020, None)], "fiscal_year int, cash double")
    assert sorted(rows(clean.fill_group_median(odd, ["cash"])), key=str) == [(2020, 1.0), (2020, 1.0), (None, None)]


@pytest.mark.parametrize("count", [99, 100, 101, 1000])
def test_winsorize_needs_a_hundred_values(spark, count):
    rng = np.random.default_rng(count)
    values = pd.Series(rng.lognormal(3, 4, count) * rng.choice([-1, 1], count))
    frame = pd.DataFrame({"id": range(count), "x": values})
    frame.loc[count] = [count, np.nan]
    frame["id"] = frame["id"].astype(int)
    want = frame.copy()
    if count >= 100:
        want["x"] = frame["x"].clip(values.quantile(0.01), values.quantile(0.99))
    df = to_spark(spark, frame)
    assert_same(clean.winsorize(df, ["x"]), want, ["id"])
    bounds = clean.quantile_bounds(df, ["x"])
    if count >= 100:
        outside = int(((frame["x"] < values.quantile(0.01)) | (frame["x"] > values.quantile(0.99))).sum())
        assert rows(clean.outside_counts(df, bounds)) == [("x", outside)]
    else:
        assert bounds == {}


def test_quantiles_with_ties_groups_and_extremes(spark):
    rng = np.random.default_rng(1)
    size = 4000
    frame = pd.DataFrame({
        "g": rng.choice(["a", "b", "c"], size, p=[0.7, 0.25, 0.05]),
        "hot": np.where(rng.random(size) < 0.4, 7.0, rng.normal(0, 1, size)),
        "wide": rng.choice([-1, 1], size) * 10.0 ** rng.uniform(-300, 300, size),
        "near": 1e6 + rng.integers(0, 50, size) / 1000,
        "same": 3.0,
    })
    frame.loc[::11, "hot"] = np.nan
    df = to_spark(spark, frame).repartition(5)
    probabilities = {"a": 0.0, "b": 0.013, "c": 0.5, "d": 0.99, "e": 1.0}
    columns = ["hot", "wide", "near", "same"]
    for row in exact_quantiles(df, columns, probabilities, by=["g"]).collect():
        series = frame.loc[frame["g"] == row["g"], row["column"]].dropna()
        assert row["n"] == len(series)
        for name, p in probabilities.items():
            assert row[name] == pytest.approx(series.quantile(p), rel=1e-9), (row["g"], row["column"], name)
    overall = {r["column"]: r for r in exact_quantiles(df, columns, {"m": 0.5}).collect()}
    assert overall["hot"]["m"] == pytest.approx(frame["hot"].median())


def test_duplicates_keep_the_most_complete_row(spark):
    data = [
        ("A", D(2020, 3, 31), D(2020, 5, 1), 1.0, None, None),
        ("A", D(2020, 3, 31), D(2020, 4, 1), 1.0, 2.0, None),
        ("B", D(2020, 3, 31), D(2020, 4, 1), 1.0, None, None),
        ("B", D(2020, 3, 31), D(2020, 5, 1), None, 3.0, None),
        ("C", None, None, 1.0, 1.0, 1.0),
        ("C", None, None, 2.0, None, None),
    ]
    df = spark.createDataFrame(data, "ticker string, period_end date, filing_date date, x double, y double, z double")
    got = dedupe.keep_most_complete(df, ["ticker", "period_end"], [F.desc_nulls_last("filing_date")])
    assert rows(got.select("ticker", "x", "y"), "ticker") == [("A", 1.0, 2.0), ("B", None, 3.0), ("C", 1.0, 1.0)]


def test_impossible_values(spark):
    df = spark.createDataFrame([(-1.0, 5.0), (0.0, -2.0), (None, None)], "revenue double, equity double")
    assert rows(clean.drop_impossible(df)) == [(None, 5.0), (0.0, -2.0), (None, None)]
    assert rows(clean.impossible_counts(df)) == [("revenue", 1)]


def test_sparse_columns_go_but_keys_and_flags_stay(spark):
    data = [(i, 2020, None, 1.0 if i < 5 else None, None) for i in range(101)]
    df = spark.createDataFrame(data, "sic_code int, fiscal_year int, empty double, few double, flag boolean")
    assert clean.drop_sparse_columns(df).columns == ["sic_code", "fiscal_year", "flag"]


def test_text_is_tidied(spark):
    df = spark.createDataFrame([(" acme corp", " ab ", " x ", None)], "company string, ticker string, sic_description string, target_sector string")
    assert rows(clean.tidy_text(df)) == [("Acme Corp", "AB", "x", None)]


def test_whole_chain_matches_pandas(spark):
    frame, names = random_panel(11, tickers=30)
    raw = pd.concat([frame, frame.iloc[::7].assign(cash=np.nan, equity=np.nan)], ignore_index=True)
    cleaned = clean_panel(to_spark(spark, raw))

    want = raw.copy()
    for name in ("revenue", "total_assets", "current_assets"):
        want.loc[want[name] < 0, name] = np.nan
    want["_n"] = want.isna().sum(axis=1)
    want = want.sort_values("_n", kind="stable").drop_duplicates(["ticker", "period_end"]).drop(columns="_n")
    want = want.sort_values(["ticker", "period_end"]).reset_index(drop=True)
    stock = ["total_assets", "equity", "current_assets", "cash", "total_liabilities"]
    want[stock] = want.groupby("ticker")[stock].ffill()
    for name in stock:
        want[name] = want.groupby("fiscal_year")[name].transform(lambda s: s.fillna(s.median()))
    def clipped(series):
        if series.notna().sum() < 100:
            return series
        return series.clip(series.quantile(0.01), series.quantile(0.99))

    want[names] = want[names].apply(clipped)
    gap = (want["total_assets"] - want["total_liabilities"] - want["equity"]).abs()
    want["balance_sheet_difference"] = gap
    lagged = ["revenue", "net_income", "total_assets", "equity", "current_assets"]
    for name in lagged:
        want[f"{name}_lag1"] = want.groupby("ticker")[name].shift(1)
    for name in lagged[:4]:
        lag = want[f"{name}_lag1"]
        want[f"{name}_growth_qoq"] = ((want[name] - lag) / lag.abs()).where(lag.fillna(0) != 0).round(4)
    for name in [c for c in want.columns if c.endswith(("_lag1", "_growth_qoq"))]:
        want[name] = clipped(want[name])
    assert_same(cleaned.panel.drop("balance_sheet_valid"), want, ["ticker", "period_end"])
    counts = dict(rows(cleaned.counters))
    assert counts["duplicate_rows_removed"] == len(raw) - len(want)
    assert counts["impossible_values_fixed"] == int((raw[["revenue", "total_assets", "current_assets"]] < 0).sum().sum())
    assert counts["columns_dropped"] == 0 and counts["values_winsorized"] > 0


def test_fill_and_dedupe_are_idempotent(spark):
    frame, _ = random_panel(3)
    df = to_spark(spark, frame)
    once = clean.forward_fill(dedupe.keep_most_complete(df, ["ticker", "period_end"]))
    twice = clean.forward_fill(dedupe.keep_most_complete(once, ["ticker", "period_end"]))
    assert rows(once, "ticker", "period_end") == rows(twice, "ticker", "period_end")


def test_reports(spark):
    frame, names = random_panel(2)
    df = to_spark(spark, frame)
    coverage = dict(rows(quality.coverage(df, names)))
    assert coverage == {n: round(frame[n].notna().mean() * 100, 1) for n in names}
    assert dict(rows(quality.missing_counts(df, names))) == {n: int(frame[n].isna().sum()) for n in names}
    doubled = df.unionByName(df.limit(4))
    report = {(m, c): v for m, c, v in rows(quality.schema_report(doubled))}
    assert report["duplicate_keys", ""] == 4 and report["valid_quarters", "fiscal_quarter"] == 1
    assert report["missing_column", "company"] == 1 and report["fiscal_year_min", "fiscal_year"] == 2015
    bad = df.withColumn("fiscal_quarter", F.lit(None).cast("int"))
    assert rows(quality.schema_report(bad).where("metric = 'valid_quarters'").select("value")) == [(0.0,)]
    numbers = {r["column"]: r for r in quality.describe_numbers(df, names).collect()}
    want = frame[names].describe()
    for name in names:
        assert numbers[name]["q25"] == pytest.approx(want[name]["25%"])
        assert numbers[name]["std"] == pytest.approx(want[name]["std"])
    texts = rows(quality.describe_texts(spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "x string"), ["x"]))
    assert texts == [("x", 3, 2, "b", 2)]
