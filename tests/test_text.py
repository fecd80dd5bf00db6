"""Identifiers, classes and labels."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ledgerloom import rules
from ledgerloom.functions import numbers as nm
from ledgerloom.functions import text as tx


def apply(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id int, v {kind}")
    return [r[0] for r in df.orderBy("id").select(expression(F.col("v"))).collect()]


def test_cik(spark):
    values = ["320193", "320193.0", "abc", None, "12345678901", " 77 ", "-5", "NaN", "inf"]
    assert apply(spark, values, tx.normal_cik) == [
        "0000320193", "0000320193", "0000000000", "0000000000", "12345678901", "0000000077", "-000000005",
        "0000000000", "0000000000",
    ]
    assert apply(spark, ["0000320193", "0", "7"], tx.bare_cik) == ["320193", "", "7"]
    assert apply(spark, ["320193"], tx.spreadsheet_id) == ['="0000320193"']


def test_zero_fill_never_cuts(spark):
    assert apply(spark, ["1", "123456", "+1"], lambda c: tx.zero_fill(c, 4)) == ["0001", "123456", "+001"]


def test_title_case_and_spaces(spark):
    values = ["o'reilly", "AT&T inc", " two words ", "a\\xa0b", "3m co", None]
    assert apply(spark, values, tx.tidy_company) == ["O'Reilly", "At&T Inc", "Two Words", "A B", "3M Co", None]


@pytest.mark.parametrize(
    ("ticker", "kind"),
    [
        ("AMSYF", "FOREIGN_OTC"), ("CXMSF", "FOREIGN_OTC"), ("hlncff", "FOREIGN_OTC"), ("ABCDEF", "FOREIGN_OTC"),
        ("CLF", "PRIMARY"), ("YF", "PRIMARY"), ("LNZAWT", "WARRANT"), ("ABCWS", "WARRANT"), ("LNZAW", "PRIMARY"),
        ("CTA-PA", "PREFERRED"), ("BIO-B", "CLASS_SHARE"), ("GEF-B", "CLASS_SHARE"), ("LONGER-B", "PRIMARY"),
        ("ASB-PF", "FOREIGN_OTC"), ("A-B-C", "CLASS_SHARE"), (" aapl ", "PRIMARY"),
    ],
)
def test_ticker_class(spark, ticker, kind):
    assert apply(spark, [ticker], tx.ticker_class) == [kind]


def test_ticker_quality(spark):
    got = apply(spark, ["UHAL", "UHAL-B", "ASB-PF", "ONCHW", "FOR", "XYOR", "ABCU"], tx.ticker_quality)
    assert [tuple(r) for r in got] == [(0, 0, 4), (1, 0, 6), (1, 0, 6), (0, 1, 5), (0, 0, 3), (0, 0, 4), (0, 1, 4)]


# Industry codes of well-known companies and the sectors they belong to.
KNOWN_SECTORS = {
    "3674": "Industrials", "3571": "Technology", "7370": "Technology", "7372": "Technology", "5961": "Retail",
    "3711": "Industrials", "6331": "Other / Financial / Services", "2834": "Healthcare", "5331": "Retail",
    "6021": "Other / Financial / Services", "3559": "Industrials", "7389": "Other / Financial / Services",
    "2911": "Energy", "3576": "Technology", "3531": "Industrials", "6324": "Other / Financial / Services",
    "3600": "Industrials", "2050": "Consumer Goods", "3300": "Manufacturing", "8742": "Other / Financial / Services",
    "8741": "Healthcare", "8743": "Healthcare", "": "Unknown", "x": "Unknown", "3571.0": "Unknown",
}


def test_sectors(spark):
    got = apply(spark, list(KNOWN_SECTORS), rules.sector_of_sic)
    assert got == list(KNOWN_SECTORS.values())
    assert apply(spark, [None], rules.sector_of_sic) == ["Unknown"]


def test_array_helpers(spark):
    data = [(1, ["10-K", None, "", "8-K"]), (2, []), (3, None), (4, ["10-K/A"])]
    df = spark.createDataFrame(data, "id int, f array<string>")
    got = df.select("id", tx.first_or_blank(F.col("f")), tx.lists_item(F.col("f"), "10-K"), tx.join_present(F.col("f")))
    assert rows(got, "id") == [
        (1, "10-K", True, "10-K,8-K"), (2, "", False, ""), (3, "", False, ""), (4, "10-K/A", False, "10-K/A"),
    ]


def test_money_and_percent(spark):
    values = [None, 0.0, 1.25e9, -2.0e9, 2.5e6, 3.5e6, 1234.0, -5.0, 999999.0]
    assert apply(spark, values, tx.money_label, "double") == [
        "N/A", "N/A", "$1.2B", "$-2.0B", "$2M", "$4M", "$1,234", "$-5", "$999,999",
    ]
    assert apply(spark, [0.126, None, -0.5], tx.percent_label, "double") == ["13%", "N/A", "-50%"]


def test_numeric_helpers(spark):
    data = [(1, 1.0, 0.0), (2, None, 2.0), (3, 3.0, 2.0), (4, 1.0, None)]
    df = spark.createDataFrame(data, "id int, a double, b double")
    got = df.select("id", nm.safe_divide(F.col("a"), F.col("b")), nm.clip(F.col("a"), 0, 2))
    assert rows(got, "id") == [(1, None, 1.0), (2, None, None), (3, 1.5, 2.0), (4, None, 1.0)]
    halves = apply(spark, [0.5, 1.5, 2.5, -0.5, 0.12345], lambda c: nm.round_half_even(c, 0), "double")
    assert halves == [0.0, 2.0, 2.0, 0.0, 0.0]


def test_relative_change_from_zero(spark):
    data = [(1, 5.0, 0.0), (2, -5.0, 0.0), (3, 0.0, 0.0), (4, 1.0, -2.0), (5, None, 2.0)]
    df = spark.createDataFrame(data, "id int, a double, b double")
    got = [r[1] for r in rows(df.select("id", nm.relative_change(F.col("a"), F.col("b"))), "id")]
    assert got == [float("inf"), float("-inf"), None, -1.5, None]


def test_buckets_never_decrease(spark):
    import random

    random.seed(3)
    values = [random.choice([-1, 1]) * 10 ** random.uniform(-320, 308) for _ in range(3000)]
    values += [0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, 1.0, 1.0000000001, 2.0]
    got = apply(spark, values, nm.magnitude_cell, "double")
    pairs = sorted(zip(values, got))
    assert all(a[1] <= b[1] for a, b in zip(pairs, pairs[1:]))


def test_weights_sum_to_one():
    assert all(abs(sum(w.values()) - 1) < 1e-12 for w in rules.WEIGHTS.values())
