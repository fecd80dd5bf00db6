"""Reading documents: bad files, wanted tags, units, positions."""

import datetime as dt

from conftest import document, record, rows, write_json
from pyspark.sql import functions as F

from ledgerloom.sources import documents as docs
from ledgerloom.sources import landing
from ledgerloom.sources.tables import read_csv, read_panel, read_universe, write_csv, write_panel
from ledgerloom import rules, schemas

DAY = dt.date


def test_corrupt_and_factless_files_are_rejected_not_fatal(spark, tmp_path):
    write_json(tmp_path, "GOOD.json", document(320193, "Good Co", {"Assets": {"USD": [record("2020-12-31", 5)]}}))
    write_json(tmp_path, "BROKEN.json", '{"cik": 1, "facts": {')
    write_json(tmp_path, "EMPTY.json", {"cik": 2, "entityName": "No facts"})
    documents = docs.read_fact_documents(spark, str(tmp_path))
    assert rows(docs.rejected_documents(documents), "ticker") == [("BROKEN",), ("EMPTY",)]
    facts = docs.flatten_facts(documents)
    assert rows(facts.select("ticker", "cik", "company", "tag", "unit", "pos", "period_end", "val")) == [
        ("GOOD", "0000320193", "Good Co", "Assets", "USD", 0, DAY(2020, 12, 31), 5.0)
    ]


def test_bad_cells_become_null_and_are_filtered_later(spark, tmp_path):
    items = [
        record("2020-12-31", 1),
        record(None, 2),
        record("2020-12-31", None),
        record("soon", 4),
        record("2020-12-31", 5, form="8-K"),
        record("2015-12-31", 6),
        record("2020-12-31", 7, filed=""),
    ]
    write_json(tmp_path, "X.json", document("77", "X", {"Assets": {"USD": items}}))
    facts = docs.flatten_facts(docs.read_fact_documents(spark, str(tmp_path)))
    assert facts.count() == 7
    from ledgerloom.operators.facts import accepted

    kept = accepted(facts, rules.ANNUAL_FORMS, rules.FIRST_ANNUAL_YEAR)
    assert rows(kept.select("pos", "val", "filed"), "pos") == [
        (0, 1.0, DAY(2020, 2, 1)),
        (6, 7.0, None),
    ]


def test_unit_choice_on_the_document(spark, tmp_path):
    gaap = {
        "A": {"USD/shares": [record("2020-12-31", 1)], "USD": [record("2020-12-31", 2, form="8-K")]},
        "B": {"shares": [record("2020-12-31", 3)]},
        "C": {"EUR": [record("2020-12-31", 4)], "CHF": [record("2020-12-31", 5)]},
    }
    write_json(tmp_path, "U.json", document(1, "U", gaap))
    documents = docs.read_fact_documents(spark, str(tmp_path))
    quarterly = docs.flatten_facts(documents, unit_preference=rules.QUARTERLY_UNITS)
    assert rows(quarterly.select("tag", "unit", "val"), "tag") == [("A", "USD", 2.0)]
    annual = docs.flatten_facts(documents, unit_preference=rules.ANNUAL_UNITS, any_unit=True)
    assert rows(annual.select("tag", "unit", "val"), "tag") == [
        ("A", "USD", 2.0), ("B", "shares", 3.0), ("C", "EUR", 4.0),
    ]


def test_wanted_tags_only(spark, tmp_path):
    gaap = {tag: {"USD": [record("2020-12-31", 1)]} for tag in ("Assets", "Noise")}
    write_json(tmp_path, "W.json", document(1, "W", gaap))
    facts = docs.flatten_facts(docs.read_fact_documents(spark, str(tmp_path)), tags=["Assets"])
    assert rows(facts.select("tag")) == [("Assets",)]


def test_long_facts_land_as_parquet_by_taxonomy(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    body = document(
        1, "P", {"Assets": {"USD": [record("2020-12-31", 1)]}}, {"Float": {"USD": [record("2020-06-30", 2)]}}
    )
    write_json(source, "P.json", body)
    facts = docs.flatten_facts(docs.read_fact_documents(spark, str(source)))
    docs.write_long_facts(facts, str(target))
    back = spark.read.parquet(str(target))
    assert rows(back.where("taxonomy = 'dei'").select("tag", "val")) == [("Float", 2.0)]


def test_ticker_index(spark, tmp_path):
    body = {
        "0": {"cik_str": 320193, "ticker": "AAPL", "title": "Apple Inc."},
        "1": {"cik_str": 12345678901, "ticker": "BIG", "title": "Big"},
    }
    write_json(tmp_path, "company_tickers.json", body)
    assert rows(docs.read_ticker_index(spark, str(tmp_path)), "ticker") == [
        ("AAPL", "0000320193", "Apple Inc."), ("BIG", "12345678901", "Big"),
    ]


def submission(**parts):
    base = {
        "name": "N", "sic": "3571", "sicDescription": "Computers", "tickers": ["T", "T-B"],
        "exchanges": ["Nasdaq", None, "", "NYSE"], "entityType": "operating", "stateOfIncorporation": "CA",
        "fiscalYearEnd": "0930", "addresses": {"business": {"stateOrCountryDescription": "CA"}},
        "filings": {"recent": {"form": ["10-K", "8-K"]}},
    }
    return {**base, **parts}


def test_submissions_by_file_name_and_with_defaults(spark, tmp_path):
    write_json(tmp_path, "CIK0000000011.json", submission())
    write_json(tmp_path, "CIK0000000012.json", submission(filings={"recent": {"form": ["10-K", "20-F"]}}))
    write_json(tmp_path, "CIK0000000013.json", submission(filings={"recent": {"form": ["10-K/A", "40-F"]}}))
    write_json(tmp_path, "CIK0000000014.json", {"name": "Bare", "tickers": []})
    write_json(tmp_path, "CIK0000000015.json", "{ not json")
    write_json(tmp_path, "CIK0000000011-submissions-001.json", submission(name="Part"))
    write_json(tmp_path, "other.json", submission(name="Other"))
    read = docs.read_submissions(spark, str(tmp_path))
    profiles = docs.filer_profiles(read).select("cik_key", "country", "exchanges", "files_10k", "files_20f_or_40f")
    assert rows(profiles, "cik_key") == [
        ("11", "CA", "Nasdaq,NYSE", True, False),
        ("12", "CA", "Nasdaq,NYSE", True, True),
        ("13", "CA", "Nasdaq,NYSE", False, True),
        ("14", "", "", False, False),
    ]
    categories = docs.filer_categories(read)
    assert rows(categories, "cik")[0] == ("T", "0000000011", "N", "3571", "Computers", "Technology")
    assert rows(categories, "cik")[3] == ("", "0000000014", "Bare", "", "Unknown", "Unknown")
    wanted = spark.createDataFrame([("0000000012",)], "cik string")
    assert rows(docs.read_submissions(spark, str(tmp_path), wanted).select("cik_key")) == [("12",)]


def test_worklist_orphans_and_landed_names(spark, tmp_path):
    write_json(tmp_path, "aapl.json", "{}")
    write_json(tmp_path, "GONE.json", "{}")
    landed = landing.landed_tickers(spark, str(tmp_path))
    universe = spark.createDataFrame([("AAPL",), ("MSFT",)], "ticker string")
    assert rows(landing.orphans(landed, universe)) == [("GONE",)]
    upper = landed.select(F.upper("ticker").alias("ticker"))
    assert rows(landing.fetch_worklist(universe, upper)) == [("MSFT",)]


def test_universe_csv_keeps_file_order_and_odd_tickers(spark, tmp_path):
    path = tmp_path / "u.csv"
    path.write_text(
        "ticker,cik,company,sic_code,sic_description,target_sector\n"
        "NA,1,Nano,3571,,Technology\nB,2,Beta,,,\nA,3,\"Alpha, Inc\",100,x,y\n",
        encoding="utf-8",
    )
    read = read_universe(spark, str(path))
    assert [r[0] for r in rows(read.select("ticker"), )] and rows(read.orderBy("row_id").select("ticker", "sic_code")) == [
        ("NA", "3571"), ("B", None), ("A", "100"),
    ]


def test_panel_csv_with_byte_order_mark_and_sinks(spark, tmp_path):
    names = schemas.ANNUAL_PANEL.names
    line = ["Co", "T", "320193.0", "3571", "d", "s", "2020-02-01", "2019-12-31", "2019", "4"] + ["1.5"] * 17
    (tmp_path / "p.csv").write_text("﻿" + ",".join(names) + "\n" + ",".join(line) + "\n", encoding="utf-8")
    panel = read_panel(spark, str(tmp_path / "p.csv"), schemas.ANNUAL_PANEL)
    row = panel.first()
    assert (row["company"], row["cik"], row["period_end"], row["market_value"]) == (
        "Co", "0000320193", DAY(2019, 12, 31), 1.5,
    )
    write_csv(panel, str(tmp_path / "csv"))
    assert rows(read_csv(spark, str(tmp_path / "csv"), schemas.ANNUAL_PANEL)) == rows(panel)
    write_panel(panel, str(tmp_path / "parquet"))
    assert (tmp_path / "parquet" / "fiscal_year=2019").is_dir()
