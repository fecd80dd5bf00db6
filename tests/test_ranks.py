"""Ranks, tiles and scores against pandas."""

import random

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from ledgerloom.operators import analyses, features, nearest, ranks, scoring
from test_clean import assert_same, to_spark


def random_snapshot(size=400, seed=2):
    rng = np.random.default_rng(seed)
    frame = pd.DataFrame({
        "ticker": [f"T{i:04d}" for i in range(size)],
        "target_sector": rng.choice(["Retail", "Energy", "Tech", "Empty"], size, p=[0.6, 0.2, 0.15, 0.05]),
        "total_assets": rng.lognormal(18, 3, size).round(0),
        "net_margin": np.where(rng.random(size) < 0.3, 0.1, rng.normal(0, 1, size)),
        "net_income": rng.normal(0, 5, size),
        "revenue_growth": rng.normal(0.1, 0.5, size).clip(-0.9, 2),
        "revenue_growth_3yr": rng.normal(0.1, 0.5, size).clip(-0.9, 2),
        "debt_to_equity": rng.lognormal(0, 1, size).clip(0, 20),
        "current_ratio": rng.lognormal(0, 1, size),
        "retained_earnings": rng.normal(0, 5, size),
        "market_value": rng.lognormal(19, 3, size),
        "total_revenue": rng.lognormal(18, 2, size),
    })
    for name in frame.columns[2:]:
        frame.loc[rng.random(size) < 0.25, name] = np.nan
    frame.loc[frame["target_sector"] == "Empty", ["total_assets", "market_value"]] = np.nan
    frame.loc[::37, "target_sector"] = None
    return frame


@pytest.mark.parametrize("hot_rows", [ranks.HOT_ROWS, 20])
def test_percent_rank_matches_pandas(spark, hot_rows):
    frame = random_snapshot()
    df = to_spark(spark, frame).repartition(4)
    names = ["total_assets", "net_margin", "current_ratio"]
    want = frame[["ticker"]].copy()
    for name in names:
        want[name] = frame.groupby("target_sector")[name].rank(pct=True)
    got = ranks.percent_ranks(df, "ticker", "target_sector", {n: F.col(n) for n in names}, hot_rows)
    assert_same(got, want, ["ticker"])


def pandas_scores(frame):
    def pct(name, fill):
        filled = frame.groupby("target_sector")[name].transform(
            lambda s: s.fillna(s.median() if fill is None else fill))
        return filled.groupby(frame["target_sector"]).rank(pct=True)

    def low(name):
        return (1 - pct(name, None)).fillna(0.5)

    def high(name, fill):
        return pct(name, fill).fillna(0.5)

    earning = (frame["net_income"].fillna(0) > 0) * 1.0
    retained = (frame["retained_earnings"].fillna(0) > 0) * 1.0
    small = (frame["total_assets"].fillna(0) < 5e7) * 0.15
    tight = (frame["market_value"].fillna(0) < 5e8) * 0.10
    return pd.DataFrame({
        "ticker": frame["ticker"],
        "size_score": (low("total_assets") + small).clip(0, 1) * 100,
        "profit_score": (high("net_margin", 0) * 0.6 + earning * 0.4) * 100,
        "growth_score": (high("revenue_growth", 0) * 0.6 + high("revenue_growth_3yr", 0) * 0.4) * 100,
        "health_score": (low("debt_to_equity") * 0.3 + high("current_ratio", 1.0) * 0.3 + earning * 0.2 + retained * 0.2) * 100,
        "mv_score": (low("market_value") + tight).clip(0, 1) * 100,
    })


def test_scores_match_pandas_and_stay_in_bounds(spark):
    frame = random_snapshot()
    scored = scoring.with_scores(to_spark(spark, frame))
    want = pandas_scores(frame)
    assert_same(scored.select(*want.columns), want, ["ticker"])
    for name in scoring.SCORES.values():
        low, high = scored.agg(F.min(name), F.max(name)).first()
        assert 0 <= low <= high <= 100


def test_ranking_is_complete_and_sorted(spark):
    frame = random_snapshot(seed=9).assign(company="c", fiscal_year=2024)
    ranked = scoring.export_columns(scoring.rank_targets(scoring.with_scores(to_spark(spark, frame))))
    got = rows(ranked.select("rank", scoring.COMPOSITE, "ticker"), "rank")
    assert [r[0] for r in got] == list(range(1, len(frame) + 1))
    assert got == sorted(got, key=lambda r: (-r[1], r[2])) and len({r[2] for r in got}) == len(frame)
    top = scoring.top_targets(ranked, 3)
    assert [r[0] for r in rows(top.select("rank"))] == [1, 2, 3]
    assert tuple(ranked.columns) == scoring.EXPORT


def test_row_numbers_and_tiles_match_pandas(spark):
    rng = random.Random(4)
    data = [(i, rng.choice(["a", "b", None]), float(rng.randint(0, 9))) for i in range(503)]
    df = spark.createDataFrame(data, "id int, g string, x double").repartition(7)
    frame = pd.DataFrame(data, columns=["id", "g", "x"]).sort_values(["x", "id"])
    want = {i: n for n, i in enumerate(frame["id"], 1)}
    assert dict(rows(ranks.numbered_by_sort(df, ["x", "id"]).select("id", "rank"))) == want
    grouped = dict(rows(ranks.numbered_by_sort(df, ["x", "id"], ["g"]).select("id", "rank")))
    assert grouped == {i: n + 1 for i, n in zip(frame["id"], frame.groupby("g", dropna=False).cumcount())}
    from pyspark.sql import Window

    tiles = ranks.ntile_by_sort(df, 5, ["x", "id"], ["g"]).withColumn(
        "want", F.ntile(5).over(Window.partitionBy("g").orderBy("x", "id"))
    )
    assert tiles.where("tile != want").count() == 0
    few = spark.createDataFrame([(1, "a", 1.0), (2, "a", 2.0)], "id int, g string, x double")
    assert dict(rows(ranks.ntile_by_sort(few, 5, ["x"], ["g"]).select("id", "tile"))) == {1: 1, 2: 2}


def test_growth_with_gaps_zero_and_negative_bases(spark):
    values = [1.0, None, 0.0, 5.0, -2.0, -1.0, 0.0, 0.0, -3.0, 100.0]
    frame = pd.DataFrame({"ticker": "A", "fiscal_year": range(2010, 2020), "total_revenue": values})
    df = to_spark(spark, frame)
    padded = frame["total_revenue"].ffill()
    one = padded / padded.shift(1) - 1
    three = (padded / padded.shift(3) - 1) / 3
    for name in ("total_assets", "total_liabilities", "net_income", "current_assets", "current_liabilities"):
        df = df.withColumn(name, F.lit(1.0))
    got = features.with_target_features(df)
    want = frame.assign(
        revenue_growth=one.replace({np.nan: np.nan}).clip(-0.9, 2), revenue_growth_3yr=three.clip(-0.9, 2)
    )
    assert_same(got.select(*want.columns), want, ["fiscal_year"])
    plain = features.with_target_features(df, pad=False)
    raw = frame["total_revenue"] / frame["total_revenue"].shift(1) - 1
    assert_same(plain.select("fiscal_year", "revenue_growth"),
                pd.DataFrame({"fiscal_year": frame["fiscal_year"], "revenue_growth": raw.clip(-0.9, 2)}), ["fiscal_year"])


def test_snapshot_modes(spark):
    data = [("A", 2019, 1.0, "x", 3.0), ("A", 2020, None, "y", None), ("B", 2020, None, None, None)]
    df = spark.createDataFrame(data, "ticker string, fiscal_year int, total_assets double, company string, total_revenue double")
    mixed = features.latest_values(df)
    assert rows(mixed, "ticker") == [("A", 2020, 1.0, "y", 3.0), ("B", 2020, None, None, None)]
    assert rows(features.latest_values(df, mode="latest_row"), "ticker") == [("A", 2020, None, "y", None), ("B", 2020, None, None, None)]
    assert rows(features.with_some_data(mixed).select("ticker")) == [("A",)]


def thesis(spark, size=50.0, growth=50.0, profit=50.0, health=50.0, change=None):
    df = spark.createDataFrame(
        [(size, growth, profit, health, change, "Retail")],
        "size_score double, growth_score double, profit_score double, health_score double, revenue_growth double, target_sector string",
    )
    return df.select(scoring.thesis_label()).first()[0]


def test_thesis_boundaries(spark):
    assert thesis(spark, size=80.0) == "Micro-cap Retail target"
    assert thesis(spark, size=60.0) == "Small-cap Retail target"
    assert thesis(spark, size=30.0) == "Large-cap Retail target"
    assert thesis(spark, size=30.1) == "Mid-cap Retail target"
    assert thesis(spark, growth=75.0) == "Mid-cap / steady-grower Retail target"
    assert thesis(spark, growth=75.0, change=0.31) == "Mid-cap / high-growth Retail target"
    assert thesis(spark, profit=75.0, health=35.0) == "Mid-cap / high-margin / distressed Retail target"
    assert thesis(spark, profit=35.0, health=75.0) == "Mid-cap / turnaround-candidate / low-debt Retail target"


def test_histogram_edges(spark):
    values = [0.0, 1.0, 29.99, 30.0, 15.0]
    df = spark.createDataFrame([(v, 5.0) for v in values], "a double, b double")
    got = {(c, b): n for c, b, _, _, _, _, n in rows(scoring.score_histogram(df, ["a", "b"]))}
    counts, _ = np.histogram(values, bins=30)
    assert {b: n for (c, b), n in got.items() if c == "a"} == {i: int(n) for i, n in enumerate(counts) if n}
    assert {b: n for (c, b), n in got.items() if c == "b"} == {15: 5}


def test_loss_runs_and_cash_burn(spark):
    losses = [("A", y, v) for y, v in [(2017, 1.0), (2018, -1.0), (2019, -1.0), (2020, 2.0), (2021, -1.0)]]
    df = spark.createDataFrame(losses, "ticker string, fiscal_year int, net_income double")
    assert rows(analyses.loss_runs(df)) == [("A", 2018, 2019, 2)]
    data = [("A", 2018, -1.0, 5.0), ("A", 2019, -1.0, 4.0), ("A", 2020, -1.0, 4.5), ("B", 2018, 1.0, 5.0), ("B", 2019, -1.0, 1.0)]
    burn = spark.createDataFrame(data, "ticker string, fiscal_year int, net_income double, current_assets double").withColumn("current_liabilities", F.lit(1.0))
    assert rows(analyses.cash_burners(burn)) == [("A", 1)]


def test_closest_peers_against_brute_force(spark):
    rng = np.random.default_rng(8)
    frame = pd.DataFrame({
        "ticker": [f"T{i:02d}" for i in range(60)], "target_sector": rng.choice(["a", "b"], 60),
        "fiscal_year": 2020, "m": rng.normal(0, 1, 60), "d": rng.normal(5, 3, 60),
    })
    df = to_spark(spark, frame)
    picked = df.where("ticker in ('T00', 'T01')")
    got = analyses.closest_peers(df, picked, ["m", "d"], limit=3).select("picked", "place", "peer")
    want = []
    for name in ("T00", "T01"):
        own = frame[frame["ticker"] == name].iloc[0]
        group = frame[frame["target_sector"] == own["target_sector"]]
        z = (group[["m", "d"]] - group[["m", "d"]].mean()) / group[["m", "d"]].std()
        gap = ((z - z.loc[own.name]) ** 2).sum(axis=1).drop(own.name).sort_values()
        want += [(name, i, frame.loc[j, "ticker"]) for i, j in enumerate(gap.index[:3], 1)]
    assert rows(got, "picked", "place") == want


def test_screens_health_and_outside_tables(spark):
    data = [("A", 2020, 1.0, 2.0, 10.0, 9.0, 0.5, 1.0, 1.0), ("B", 2020, 4.0, 2.0, 10.0, 4.0, None, 1.0, 2.0)]
    df = spark.createDataFrame(
        data,
        "ticker string, fiscal_year int, current_assets double, current_liabilities double, total_assets double, "
        "total_liabilities double, revenue_growth double, net_income double, total_revenue double",
    ).withColumn("target_sector", F.lit("s"))
    assert rows(analyses.screened(df).select("ticker", "screen"), "ticker", "screen") == [
        ("A", "growth"), ("A", "liquidity_risk"), ("A", "over_leveraged"),
    ]
    flagged = analyses.with_health_flag(df)
    assert rows(flagged.select("ticker", "healthy"), "ticker") == [("A", False), ("B", True)]
    assert rows(analyses.healthy_summary(flagged, 2020)) == [("s", 0.75, 1.25, 4.8333, 0.5)]
    rates = spark.createDataFrame([(2020, 0.25)], "fiscal_year int, rate double")
    assert rows(analyses.join_external(df, rates, ["fiscal_year"]).select("rate")) == [(0.25,), (0.25,)]
    with pytest.raises(ValueError):
        analyses.join_external(df, rates.withColumn("ticker", F.lit("A")), ["fiscal_year"])


def test_closest_peers_of_every_company(spark):
    """Any number of picks, many of them at one place, against brute force."""
    rng = np.random.default_rng(3)
    size = 260
    frame = pd.DataFrame({
        "ticker": [f"T{i:03}" for i in range(size)], "target_sector": "One", "fiscal_year": 2020,
        "m": rng.normal(0, 1, size).round(1), "d": rng.lognormal(0, 1, size).round(1),
    })
    frame.loc[frame.index % 3 == 0, ["m", "d"]] = [0.5, 0.5]
    df = to_spark(spark, frame)
    got = analyses.closest_peers(df, df, ["m", "d"], limit=3)
    found = {(r.picked, r.place): (r.peer, r.distance) for r in got.collect()}
    z = ((frame[["m", "d"]] - frame[["m", "d"]].mean()) / frame[["m", "d"]].std()).to_numpy()
    assert len(found) == 3 * size
    for i in range(size):
        distance = np.sqrt(((z - z[i]) ** 2).sum(1))
        mine = [found[frame.ticker[i], p + 1] for p in range(3)]
        place = [frame.index[frame.ticker == name][0] for name, _ in mine]
        assert i not in place and len(set(place)) == 3
        assert np.allclose([d for _, d in mine], np.sort(np.delete(distance, i))[:3])
        assert np.allclose([d for _, d in mine], distance[place])


def brute_peers(frame, limit):
    """(picked, place) -> distance, and all distances, of every row within its group."""
    out = {}
    for _, group in frame.groupby("target_sector"):
        z = ((group[["m", "d"]] - group[["m", "d"]].mean()) / group[["m", "d"]].std()).to_numpy()
        names = group["ticker"].to_numpy()
        for i, name in enumerate(names):
            distance = np.sqrt(((z - z[i]) ** 2).sum(1))
            for place, j in enumerate([j for j in np.lexsort((names, distance)) if j != i][:limit], 1):
                out[name, place] = (names[j], distance[j])
    return out


@pytest.mark.parametrize("broadcast", [1_000, 0])
def test_peers_of_heavy_tails(spark, monkeypatch, broadcast):
    """Log-normal columns, which a uniform grid would put into one cell, and a group smaller than the limit."""
    monkeypatch.setattr(nearest, "BROADCAST_ARRAYS", broadcast)
    rng = np.random.default_rng(11)
    size = 900
    frame = pd.DataFrame({
        "ticker": [f"T{i:03}" for i in range(size)], "target_sector": np.where(np.arange(size) < 700, "hot", rng.choice(["a", "b"], size)),
        "fiscal_year": 2020, "m": rng.lognormal(0, 3, size), "d": rng.lognormal(0, 2, size),
    })
    frame.loc[size - 3:, "target_sector"] = "tiny"
    df = to_spark(spark, frame)
    got = {(r.picked, r.place): (r.peer, r.distance) for r in analyses.closest_peers(df, df, ["m", "d"], limit=5).collect()}
    want = brute_peers(frame, 5)
    assert got.keys() == want.keys()
    assert np.allclose([got[k][1] for k in want], [want[k][1] for k in want])
    assert sum(got[k][0] != want[k][0] for k in want) == 0


def test_cells_are_bounded(spark):
    """No cell over its size and none much smaller, however the values are spread."""
    rng = np.random.default_rng(2)
    frame = pd.DataFrame({"g": rng.choice(["x", "y", "z"], 3000, p=[0.9, 0.09, 0.01]), "a": rng.lognormal(0, 4, 3000), "b": 1.0, "c": rng.normal(0, 1, 3000).round(0), "peer": range(3000)})
    placed = nearest.kd_cells(spark.createDataFrame(frame), ["a", "b", "c"], ["g"], "peer", 20)
    sizes = placed.groupBy("g", "_c0", "_c1", "_c2").count().toPandas()
    assert sizes["count"].max() <= 20 and sizes["count"].sum() == 3000 and sizes["count"].min() >= 5


def test_peers_meet_in_no_cross_join(spark):
    rows_ = spark.createDataFrame([(f"T{i}", "s", float(i % 7), float(i)) for i in range(40)], "ticker string, target_sector string, m double, d double")
    found = nearest.nearest_in_groups(rows_, rows_, ["m", "d"], ["target_sector"], "ticker", 3, cell=8)
    text = found._jdf.queryExecution().toString()
    assert "CartesianProduct" not in text and "NestedLoop" not in text and found.count() == 120
