"""Joining statements, and the identity check."""

import datetime as dt

from conftest import rows

from ledgerloom.operators import statements as st

D = dt.date
STATEMENTS = {"balance": ("assets",), "income": ("sales", "profit"), "cash": ("flow",)}
OF_FIELD = {field: (name, order) for order, (name, field) in enumerate(
    (name, field) for name, fields in STATEMENTS.items() for field in fields)}


def resolved(spark, cells):
    data = [(cik, *(OF_FIELD[f][0], f, OF_FIELD[f][1]), period, filed, val) for cik, f, period, filed, val in cells]
    return spark.createDataFrame(
        data, "cik string, statement string, field string, field_order int, period_end date, filed date, val double"
    )


P1, P2 = D(2020, 3, 31), D(2020, 6, 30)
F1, F2 = D(2020, 5, 1), D(2020, 8, 1)


def merge(spark, cells, **options):
    got = st.merge_statements(resolved(spark, cells), ["cik"], STATEMENTS, **options)
    return rows(got.select("cik", "period_end", "filing_date", "assets", "sales", "profit", "flow"), "cik", "period_end")


def test_equal_filing_dates_join_and_different_ones_do_not(spark):
    cells = [("1", "assets", P1, F1, 1.0), ("1", "sales", P1, F1, 2.0), ("1", "flow", P1, F2, 3.0)]
    assert merge(spark, cells) == [("1", P1, F1, 1.0, 2.0, None, None)]
    assert merge(spark, cells, join_on="period") == [("1", P1, F1, 1.0, 2.0, None, 3.0)]


def test_null_filing_dates_match_each_other(spark):
    cells = [("1", "assets", P1, None, 1.0), ("1", "sales", P1, None, 2.0), ("1", "flow", P1, F1, 3.0)]
    assert merge(spark, cells) == [("1", P1, None, 1.0, 2.0, None, None)]


def test_periods_missing_from_the_base_are_dropped(spark):
    cells = [("1", "assets", P1, F1, 1.0), ("1", "sales", P2, F2, 2.0)]
    assert merge(spark, cells) == [("1", P1, F1, 1.0, None, None, None)]


def test_base_falls_back_per_company(spark):
    cells = [
        ("1", "sales", P1, F1, 2.0), ("1", "flow", P1, F1, 3.0), ("1", "flow", P2, F2, 4.0),
        ("2", "flow", P1, F1, 5.0),
    ]
    assert merge(spark, cells) == [
        ("1", P1, F1, None, 2.0, None, 3.0),
        ("2", P1, F1, None, None, None, 5.0),
    ]


def test_filing_date_is_that_of_the_first_field_present(spark):
    cells = [("1", "profit", P1, F1, 2.0), ("1", "sales", P1, F2, 1.0)]
    assert merge(spark, cells) == [("1", P1, F2, None, 1.0, 2.0, None)]
    frame = st.statement_frame(resolved(spark, cells), STATEMENTS["income"], ["cik"])
    assert rows(frame.select("filing_date", "fiscal_year", "fiscal_quarter")) == [(F2, 2020, 1)]


def test_unknown_join_mode_is_refused(spark):
    try:
        merge(spark, [("1", "assets", P1, F1, 1.0)], join_on="nothing")
    except ValueError:
        return
    raise AssertionError("accepted")


def test_identity_tolerances(spark):
    df = spark.createDataFrame(
        [
            (1, 10.0, 4.0, 6.0),
            (2, 10_000_000.0, 4_000_000.0, 5_000_000.0),
            (3, 1e9, 4e8, 5.85e8),
            (4, 10.0, 4.0, None),
            (5, None, 4.0, 6.0),
        ],
        "id int, total_assets double, total_liabilities double, equity double",
    )
    strict, loose = st.identity_check(df, 0.01), st.identity_check(df, 0.02)
    flags = [r[0] for r in rows(strict.orderBy("id").select("balance_sheet_valid"))]
    assert flags == [True, True, False, False, False]
    assert [r[0] for r in rows(loose.orderBy("id").select("balance_sheet_valid"))] == [True, True, True, False, False]
    assert rows(st.identity_counts(loose)) == [(3, 2)]
    assert rows(strict.orderBy("id").select("balance_sheet_difference"))[:2] == [(0.0,), (1e6,)]


def test_columns_can_be_completed_ordered_and_stacked(spark):
    a = spark.createDataFrame([(1, 2.0)], "id int, x double")
    b = spark.createDataFrame([(2, "y")], "id int, y string")
    full = st.ensure_columns(a, {"x": "double", "z": "double"})
    assert full.dtypes == [("id", "int"), ("x", "double"), ("z", "double")]
    assert st.in_order(full, ["z", "nothing", "id"]).columns == ["z", "id"]
    assert rows(st.concat_panels(a, b), "id") == [(1, 2.0, None), (2, None, "y")]


def test_metadata_is_a_left_join(spark):
    panel = spark.createDataFrame([("1", 5.0), ("2", 6.0)], "cik string, x double")
    universe = spark.createDataFrame([("1", "100", "d", "s")], "cik string, sic_code string, sic_description string, target_sector string")
    assert rows(st.with_metadata(panel, universe), "cik") == [("1", 5.0, "100", "d", "s"), ("2", 6.0, None, None, None)]

