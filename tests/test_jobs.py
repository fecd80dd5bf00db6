"""Whole jobs from files to results."""

import datetime as dt
import re

from conftest import document, record, rows, write_json
from test_documents import submission

from ledgerloom import rules, schemas
from ledgerloom.operators import statements
from ledgerloom.plans import cleaning, companies, panels, targets
from ledgerloom.sources import documents as docs
from ledgerloom.sources.tables import write_csv

D = dt.date
UNIVERSE = "ticker string, cik string, company string, sic_code string, sic_description string, target_sector string"


def universe(spark):
    return spark.createDataFrame(
        [("AAA", "0000000001", "A Co", "3571", "Computers", "Technology")], UNIVERSE
    )


def landed(spark, folder):
    gaap = {
        "Assets": {"USD": [
            record("2019-12-31", 100, filed="2020-02-01"),
            record("2020-12-31", 200, filed="2021-02-01"),
            record("2019-12-31", 110, filed="2021-02-01"),
        ]},
        "Liabilities": {"USD": [record("2019-12-31", 60, filed="2021-02-01"), record("2020-12-31", 90, filed="2021-02-01")]},
        "StockholdersEquity": {"USD": [record("2020-12-31", 110, filed="2021-02-01")]},
        "Revenues": {"USD": [record("2019-12-31", 50, filed="2021-02-01")]},
        "SalesRevenueNet": {"USD": [record("2020-12-31", 80, filed="2021-02-01")]},
        "NetIncomeLoss": {"USD": [record("2020-12-31", 8, filed="2021-02-01"), record("2020-12-31", 1, form="8-K")]},
        "EarningsPerShareBasic": {"USD/shares": [record("2020-12-31", 1.5, filed="2021-02-01")]},
        "Depreciation": {"USD": [record("2020-12-31", 4, filed="2021-03-01")]},
    }
    dei = {"EntityPublicFloat": {"USD": [record("2020-06-30", 999, filed="2021-02-01")]}}
    write_json(folder, "AAA.json", document(1, "A Co", gaap, dei))
    only_income = {"NetIncomeLoss": {"USD": [record("2020-12-31", -3, form="10-Q")]}}
    write_json(folder, "BBB.json", document(2, "B Co", only_income))
    write_json(folder, "BAD.json", "nothing")
    return docs.read_fact_documents(spark, str(folder))


def test_quarterly_panel_from_documents(spark, tmp_path):
    documents = landed(spark, tmp_path)
    panel = panels.quarterly_panel(panels.quarterly_facts(documents), universe(spark))
    # Columns, order and types are fixed whatever fields the documents hold.
    assert [(f.name, f.dataType) for f in panel.schema] == [(f.name, f.dataType) for f in schemas.QUARTERLY_PANEL]
    got = panel.select(
        "ticker", "period_end", "filing_date", "target_sector", "total_assets", "revenue", "net_income", "basic_eps",
        "depreciation", "balance_sheet_valid",
    )
    assert rows(got, "ticker", "period_end") == [
        ("AAA", D(2019, 12, 31), D(2021, 2, 1), "Technology", 110.0, 50.0, None, None, None, False),
        ("AAA", D(2020, 12, 31), D(2021, 2, 1), "Technology", 200.0, 80.0, 8.0, 1.5, None, True),
        ("BBB", D(2020, 12, 31), D(2020, 2, 1), None, None, None, -3.0, None, None, False),
    ]
    assert panel.groupBy("ticker", "period_end").count().where("count > 1").count() == 0
    loose = panels.quarterly_panel(panels.quarterly_facts(documents), universe(spark), join_on="period")
    assert rows(loose.where("depreciation is not null").select("depreciation")) == [(4.0,)]


def test_stored_facts_give_the_same_panel(spark, tmp_path):
    source, store = tmp_path / "in", tmp_path / "store"
    source.mkdir()
    documents = landed(spark, source)
    docs.write_long_facts(panels.quarterly_facts(documents), str(store))
    direct = panels.quarterly_dataset(panels.quarterly_facts(documents), universe(spark))
    stored = panels.quarterly_dataset(spark.read.parquet(str(store)), universe(spark))
    assert rows(direct, "ticker", "period_end") == rows(stored, "ticker", "period_end")
    assert set(rules.QUARTERLY_RATIOS) <= set(direct.columns)


def test_annual_panel_from_documents(spark, tmp_path):
    panel = panels.annual_panel(panels.annual_facts(landed(spark, tmp_path)), universe(spark))
    assert [(f.name, f.dataType) for f in panel.schema] == [(f.name, f.dataType) for f in schemas.ANNUAL_PANEL]
    got = panel.select(
        "ticker", "fiscal_year", "fiscal_quarter", "period_end", "filing_date", "total_assets", "net_sales",
        "total_revenue", "market_value",
    )
    # 2019 has only assets and liabilities, since the revenue tag of 2020 supplies all years.
    assert rows(got) == [("AAA", 2020, 4, D(2020, 12, 31), D(2021, 3, 1), 200.0, 80.0, 80.0, 999.0)]


def test_targets_from_an_annual_panel(spark):
    fields = list(rules.ANNUAL_FIELDS)
    data = []
    for i in range(6):
        for year in (2021, 2022, 2023, 2024):
            data.append(("Co", f"T{i}", "1", "1", "d", "AB"[i % 2], None, None, year, 4,
                         *[float(100 + i * 7 + (year - 2020) * (j + 1)) for j in range(len(fields))]))
    annual = spark.createDataFrame(data, schemas.ANNUAL_PANEL)
    result = targets.acquisition_targets(annual)
    ranked = result.ranked.collect()
    assert [r["rank"] for r in ranked] == [1, 2, 3, 4, 5, 6]
    assert {r["fiscal_year"] for r in ranked} == {2024}
    best = {}
    for r in ranked:
        best.setdefault(r["target_sector"], r["ticker"])
    assert {r["target_sector"]: r["top_target"] for r in result.sectors.collect()} == best
    assert sorted(r["companies"] for r in result.sectors.collect()) == [3, 3]


def test_universe_from_documents(spark, tmp_path):
    index, filers = tmp_path / "index", tmp_path / "filers"
    index.mkdir(), filers.mkdir()
    write_json(index, "tickers.json", {
        "0": {"cik_str": 11, "ticker": "aaa", "title": "A"},
        "1": {"cik_str": 11, "ticker": "AAA-B", "title": "A"},
        "2": {"cik_str": 12, "ticker": "FRGN", "title": "F"},
        "3": {"cik_str": 13, "ticker": "SPAC", "title": "S"},
        "4": {"cik_str": 14, "ticker": "NODOC", "title": "N"},
    })
    write_json(filers, "CIK0000000011.json", submission())
    write_json(filers, "CIK0000000012.json", submission(filings={"recent": {"form": ["10-K", "20-F"]}}))
    write_json(filers, "CIK0000000013.json", submission(sic="6770"))
    got = companies.company_universe(spark, str(index), str(filers))
    assert rows(got.select("ticker", "cik", "company", "target_sector")) == [("AAA", "0000000011", "A", "Technology")]


def test_cleaning_files(spark, tmp_path):
    data = []
    for i in range(30):
        for quarter in range(1, 5):
            row = {name: None for name in schemas.QUARTERLY_PANEL_WITH_RATIOS.names}
            row.update(company=f"co {i}", ticker=f"t{i}", cik=str(i), period_end=D(2020, quarter * 3, 28),
                       fiscal_year=2020, fiscal_quarter=quarter, total_assets=float(i * quarter), revenue=float(i - 3))
            data.append(tuple(row.values()))
    raw = spark.createDataFrame(data, schemas.QUARTERLY_PANEL_WITH_RATIOS)
    write_csv(raw, str(tmp_path / "raw"))
    result = cleaning.clean_files(spark, str(tmp_path / "raw"), str(tmp_path / "clean"), str(tmp_path / "report"))
    written = spark.read.parquet(str(tmp_path / "clean"))
    assert written.count() == 120 and "goodwill" in result.dropped and "goodwill" not in written.columns
    assert rows(written.select("cik", "ticker").orderBy("cik").limit(1)) == [("0000000000", "T0")]
    report = spark.read.option("header", True).csv(str(tmp_path / "report"))
    found = {(r["section"], r["metric"]): r["value"] for r in report.where("section != 'schema'").collect()}
    assert found["before", "rows"] == "120.0" and found["removed", "rows"] == "0.0"
    assert dict(rows(result.counters))["impossible_values_fixed"] == 12


def test_fixed_columns(spark):
    df = spark.createDataFrame([("1",)], "cik string")
    full = statements.ensure_columns(df, {name: "double" for name in rules.QUARTERLY_FIELDS})
    assert len(full.columns) == 31


def test_facts_reach_the_panels_in_two_shuffles(spark, tmp_path):
    """Field values, then companies; hash aggregation only, and every document is parsed once."""
    documents = landed(spark, tmp_path)
    quarterly = panels.quarterly_panel(panels.quarterly_facts(documents), universe(spark))
    annual = panels.annual_panel(panels.annual_facts(documents), universe(spark))
    for panel in (quarterly, annual):
        text = panel._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in text and "Python" not in text and "BroadcastHashJoin" in text
        facts_side = text.split("SortMergeJoin")[-1].rsplit("Exchange hashpartitioning(cik", 1)[0]
        assert len(re.findall(r"Exchange hashpartitioning\(ticker", facts_side)) == 2
        assert text.count("from_json(") == 1


def test_stored_facts_in_several_units_do_not_mix(spark, tmp_path):
    """A later filing in another unit must not replace the value in the preferred one."""
    gaap = {
        "Assets": {
            "EUR": [record("2020-12-31", 999, filed="2022-02-01")],
            "USD": [record("2020-12-31", 100, filed="2021-02-01")],
        },
        "NetIncomeLoss": {"EUR": [record("2020-12-31", 5, filed="2021-02-01")]},
    }
    write_json(tmp_path, "AAA.json", document(1, "A Co", gaap))
    long = docs.flatten_facts(docs.read_fact_documents(spark, str(tmp_path)))
    quarterly = panels.quarterly_panel(long, universe(spark)).select("total_assets", "net_income")
    assert rows(quarterly) == [(100.0, None)]
    kept = panels.in_one_unit(long, rules.ANNUAL_FORMS, rules.ANNUAL_UNITS, any_unit=True).select("tag", "val")
    assert rows(kept, "tag") == [("Assets", 100.0), ("NetIncomeLoss", 5.0)]
