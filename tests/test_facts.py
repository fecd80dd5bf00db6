"""Which reported value counts."""

import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from ledgerloom import rules
from ledgerloom.operators import facts as fx
from ledgerloom.operators import annual

D = dt.date
SCHEMA = "cik string, tag string, period_end date, pos int, filed date, val double"


def latest(spark, records):
    data = [("1", "T", D(2020, 12, 31), pos, filed, val) for pos, (filed, val) in enumerate(records)]
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    return rows(fx.latest_filing(df, ["cik", "tag", "period_end"], ["val"]).select("filed", "val"))


def test_later_filing_replaces(spark):
    assert latest(spark, [(D(2021, 2, 1), 1.0), (D(2022, 2, 1), 2.0)]) == [(D(2022, 2, 1), 2.0)]


def test_equal_filing_dates_keep_the_earlier_position(spark):
    assert latest(spark, [(D(2021, 2, 1), 9.0), (D(2021, 2, 1), 1.0)]) == [(D(2021, 2, 1), 9.0)]


def test_undated_first_record_is_never_replaced(spark):
    assert latest(spark, [(None, 5.0), (D(2022, 2, 1), 2.0)]) == [(None, 5.0)]


def test_undated_later_record_never_replaces(spark):
    assert latest(spark, [(D(2020, 2, 1), 5.0), (None, 2.0)]) == [(D(2020, 2, 1), 5.0)]


def test_only_undated_records_keep_the_first(spark):
    assert latest(spark, [(None, 1.0), (None, 2.0)]) == [(None, 1.0)]


def test_unit_is_chosen_before_the_form_filter(spark):
    data = [
        ("1", "A", "USD", "8-K", D(2020, 12, 31), 0, D(2021, 1, 1), 1.0),
        ("1", "A", "USD/shares", "10-K", D(2020, 12, 31), 0, D(2021, 1, 1), 2.0),
        ("1", "B", "USD/shares", "10-K", D(2020, 12, 31), 0, D(2021, 1, 1), 3.0),
        ("1", "C", "EUR", "10-K", D(2020, 12, 31), 0, D(2021, 1, 1), 4.0),
        ("1", "D", "USD", "8-K", D(2019, 12, 31), 0, D(2021, 1, 1), 5.0),
        ("1", "D", "USD", "10-K", D(2020, 12, 31), 1, D(2021, 1, 1), 6.0),
    ]
    df = spark.createDataFrame(
        data, "cik string, tag string, unit string, form string, period_end date, pos int, filed date, val double"
    )
    good = F.col("form").isin(*rules.QUARTERLY_FORMS)

    def read(rank):
        return rows(fx.latest_in_preferred_unit(df, ["cik", "tag"], "period_end", rank, good, ["val"]).select("tag", "val"), "tag")

    assert read(fx.unit_rank(F.col("unit"), rules.QUARTERLY_UNITS)) == [("B", 3.0), ("D", 6.0)]
    with_any = fx.unit_rank(F.col("unit"), rules.ANNUAL_UNITS, F.lit(0))
    assert read(with_any) == [("B", 3.0), ("C", 4.0), ("D", 6.0)]


def fallback_facts(spark):
    data = [("1", "first", D(y, 12, 31), 0, D(y + 1, 1, 1), float(y)) for y in (2016, 2017, 2018)]
    data += [("1", "second", D(y, 12, 31), 0, D(y + 1, 1, 1), -float(y)) for y in (2018, 2019, 2020)]
    rule = [("first", "s", "f", 0, 0), ("second", "s", "f", 0, 1), ("second", "s", "g", 1, 0)]
    tags = spark.createDataFrame(rule, "tag string, statement string, field string, field_order int, priority int")
    return fx.with_fields(fx.with_calendar(spark.createDataFrame(data, SCHEMA)), tags, ["tag"])


def test_fallback_per_period_fills_all_years(spark):
    got = fx.resolve_by_period(fallback_facts(spark), ["cik"]).where("field = 'f'")
    assert rows(got.select(F.year("period_end"), "val"), "period_end") == [
        (2016, 2016.0), (2017, 2017.0), (2018, 2018.0), (2019, -2019.0), (2020, -2020.0),
    ]


def test_fallback_per_company_loses_the_other_tags_years(spark):
    got = fx.resolve_by_entity(fallback_facts(spark), ["cik"])
    assert rows(got.where("field = 'f'").select("fiscal_year"), "fiscal_year") == [(2016,), (2017,), (2018,)]
    assert rows(got.where("field = 'g'").select("fiscal_year"), "fiscal_year") == [(2018,), (2019,), (2020,)]


def test_undated_best_tag_beats_dated_fallback(spark):
    data = [
        ("1", "first", D(2020, 12, 31), 0, None, 1.0),
        ("1", "second", D(2020, 12, 31), 0, D(2021, 1, 1), 2.0),
    ]
    rule = [("first", "s", "f", 0, 0), ("second", "s", "f", 0, 1)]
    tags = spark.createDataFrame(rule, "tag string, statement string, field string, field_order int, priority int")
    tagged = fx.with_fields(spark.createDataFrame(data, SCHEMA), tags, ["tag"])
    assert rows(fx.resolve_by_period(tagged, ["cik"]).select("priority", "val")) == [(0, 1.0)]


def test_quarter_codes(spark):
    df = spark.createDataFrame(
        [("Q1", D(2020, 12, 31)), ("FY", D(2020, 3, 31)), ("XX", D(2020, 8, 31)), (None, D(2020, 5, 1))],
        "fp string, period_end date",
    )
    got = df.select(fx.reported_quarter(F.col("fp"), F.col("period_end")).alias("q"))
    assert [r[0] for r in got.collect()] == [1, 4, 3, 2]


def test_year_group_takes_the_anchor_period(spark):
    data = [
        ("1", "total_assets", 7, D(2016, 10, 31), D(2016, 12, 20), 10.0),
        ("1", "net_income", 4, D(2016, 10, 31), D(2016, 12, 20), 2.0),
        ("1", "market_value", 15, D(2016, 4, 30), D(2016, 12, 20), 99.0),
        ("1", "shares_outstanding", 16, D(2016, 12, 1), D(2017, 1, 5), 7.0),
        ("2", "market_value", 15, D(2016, 4, 30), None, 1.0),
        ("2", "shares_outstanding", 16, D(2016, 12, 1), None, 7.0),
    ]
    df = spark.createDataFrame(
        data, "cik string, field string, field_order int, period_end date, filed date, val double"
    ).withColumn("fiscal_year", F.lit(2016))
    got = annual.collapse_year(df, ["cik"]).select(
        "cik", "fiscal_year", "fiscal_quarter", "period_end", "filing_date", "total_assets", "market_value", "inventory"
    )
    assert rows(got, "cik") == [
        ("1", 2016, 4, D(2016, 10, 31), D(2017, 1, 5), 10.0, 99.0, None),
        ("2", 2016, 4, D(2016, 4, 30), None, None, 1.0, None),
    ]


def test_sparse_rows_go_before_revenue_is_copied(spark):
    df = spark.createDataFrame(
        [(1, 5.0, None, 1.0, None), (2, 5.0, None, 1.0, 2.0)],
        "id int, net_sales double, total_revenue double, a double, b double",
    )
    kept = annual.drop_sparse_rows(df, ["net_sales", "total_revenue", "a", "b"], 3)
    assert rows(annual.cross_fill(kept)) == [(2, 5.0, 5.0, 1.0, 2.0)]
