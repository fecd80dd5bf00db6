"""Cleaning and choosing companies."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ledgerloom.operators import dedupe, quality
from ledgerloom.operators import universe as un

RAW = [
    (1, "aapl", "320193.0", " Apple ", "3571"),
    (2, "AAPL", "999", "Copy of ticker", None),
    (3, "BRK", "abc", "Bad id", None),
    (4, "", "5", "Blank ticker", None),
    (5, "X", None, "No id", None),
    (6, "BIG", "12345678901", "Long id", None),
    (7, "APC", "320193", "Copy of id", None),
    (8, "Y", "8", "   ", None),
    (9, "Z9", "999", "Kept: its twin went with the ticker", None),
    (10, "NA", "10", "Not missing", None),
]
SCHEMA = "row_id int, ticker string, cik string, company string, sic_code string"


def test_clean_universe(spark):
    got = un.company_list(spark.createDataFrame(RAW, SCHEMA))
    assert rows(got.select("ticker", "cik", "company", "sic_code", "target_sector"), "ticker") == [
        ("AAPL", "0000320193", "Apple", "3571", ""),
        ("BIG", "12345678901", "Long id", None, ""),
        ("BRK", "0000000000", "Bad id", None, ""),
        ("NA", "0000000010", "Not missing", None, ""),
        ("Z9", "0000000999", "Kept: its twin went with the ticker", None, ""),
    ]


def test_required_columns(spark):
    with pytest.raises(ValueError, match="cik"):
        un.company_list(spark.createDataFrame([("a",)], "ticker string"))
    with pytest.raises(ValueError, match="empty"):
        un.company_list(spark.createDataFrame([], SCHEMA))


def test_domestic_filers(spark):
    data = [
        (1, True, False, "Operating", "1"), (2, True, True, "operating", "1"), (3, False, False, "operating", "1"),
        (4, True, False, "other", "1"), (5, True, False, "operating", None), (6, True, False, "operating", ""),
        (7, None, None, None, "1"),
    ]
    df = spark.createDataFrame(
        data, "id int, files_10k boolean, files_20f_or_40f boolean, entity_type string, sic_code string"
    )
    assert rows(un.domestic_filers(df).select("id")) == [(1,)]


def test_shells(spark):
    df = spark.createDataFrame([(1, "6770"), (2, "6798"), (3, None), (4, "9995.0")], "id int, sic_code string")
    assert rows(un.drop_shells(df).select("id"), "id") == [(2,), (3,)]
    assert rows(un.drop_shells(df, [6798]).select("id"), "id") == [(1,), (3,), (4,)]
    assert un.drop_shells(df, keep_shells=True).count() == 4


def test_one_ticker_per_cik(spark):
    data = [("4457", "UHAL-B"), ("4457", "UHAL"), ("9", "ONCHW"), ("9", "ONCHO"), ("7", "BB"), ("7", "AA"), ("7", "AA")]
    df = spark.createDataFrame(data, "cik string, ticker string").selectExpr("*", "'100' as sic_code")
    got = un.research_universe(df)
    assert rows(got.select("cik", "filing_tag", "ticker"), "cik") == [
        ("0000000007", "10-K", "AA"), ("0000000009", "10-K", "ONCHO"), ("0000004457", "10-K", "UHAL"),
    ]


def test_shortest_primary_then_ticker(spark):
    data = [("1", "ABC", "a"), ("1", "AB", "b"), ("2", "AB", "c"), ("3", "XYZWS", "d"), ("4", "Q", "e")]
    df = spark.createDataFrame(data, "cik string, ticker string, company string")
    got = un.primary_listing(df)
    assert rows(got.select("ticker", "cik", "company", "sic_code"), "ticker") == [
        ("AB", "0000000001", "b", ""), ("Q", "0000000004", "e", ""),
    ]
    _, dropped = un.split_primary(df)
    assert rows(dropped.select("ticker", "ticker_type")) == [("XYZWS", "WARRANT")]
    assert rows(dedupe.repeated_keys(df, ["cik"])) == [("1", 2)]


def test_lookup_and_profiles_keep_unmatched(spark):
    base = spark.createDataFrame([("0000000001", "A"), ("0000000002", "B")], "cik string, ticker string")
    known = spark.createDataFrame(
        [("0000000001", "100", "d", "s")], "cik string, sic_code string, sic_description string, target_sector string"
    )
    got = un.with_filer_lookup(base, known).select("ticker", "sic_code", "sic_description", "target_sector")
    assert rows(got, "ticker") == [("A", "100", "d", "s"), ("B", "", "Unknown", "Unknown")]
    profiles = spark.createDataFrame([("1", "operating")], "cik_key string, entity_type string")
    assert rows(un.with_profiles(base, profiles).select("ticker", "entity_type"), "ticker") == [("A", "operating"), ("B", None)]
    assert rows(un.matched_only(base, profiles).select("ticker")) == [("A",)]


def test_sector_pick_and_summary(spark):
    df = spark.createDataFrame(
        [("c", "3", "R"), ("a", "1", "R"), ("b", "2", "T")], "company string, cik string, target_sector string"
    )
    assert rows(un.pick_sector(df, "R", 1).select("company")) == [("a",)]
    assert un.pick_sector(df).count() == 3
    stages = {"all": F.lit(True), "retail": F.col("target_sector") == "R", "third": F.col("cik") == "3", "late": F.col("company") > "b"}
    assert rows(quality.match_summary(df, stages), "step") == [(0, "all", 3), (1, "retail", 2), (2, "third", 1), (3, "late", 1)]
    assert rows(un.in_listing_order(df).select("position", "company")) == [(1, "a"), (2, "b"), (3, "c")]
    assert un.distinct_listings(spark.createDataFrame([("1", "ab ", "7"), ("01", "AB", "7.0")], "cik string, ticker string, sic_code string")).count() == 1
