"""Lookups by customers with orders: the whole landed side counts, whatever the numbers of the suppliers are."""

import datetime as dt
from pathlib import Path

import pytest
from compare import connect, difference

from ledgerloom.workload.oracle import SQL
from ledgerloom.workload.queries import REGISTRY


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """40 customers, of whom 30 to 35 have no order; the only supplier has the number 2."""
    folder = str(tmp_path_factory.mktemp("landed"))
    customers = [(i, f"Customer#{i}", ("BUILDING", "AUTOMOBILE")[i % 2]) for i in range(40)]
    orders = [(100 + i, i, "2-HIGH", dt.datetime(1995, 3, 1)) for i in range(40) if not 30 <= i <= 35]
    made = {
        "customer": spark.createDataFrame(customers, "c_custkey long, c_name string, c_mktsegment string"),
        "orders": spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderpriority string, o_orderdate timestamp_ntz"),
        "supplier": spark.createDataFrame([(2,)], "s_suppkey long"),
    }
    for name, df in made.items():
        df.coalesce(1).write.parquet(f"{folder}/parts/{name}")
        part = next(Path(f"{folder}/parts/{name}").glob("*.parquet"))
        part.rename(f"{folder}/{name}.parquet")
    return folder


def test_profiles_of_all_customers_with_orders(spark, tables):
    found = REGISTRY["profile_join"](spark, tables)
    missing = {r["row_id"] for r in found.where("entity_type is null").collect()}
    assert missing == {0, 1, *range(30, 36)}  # company 0 is none
    assert difference(REGISTRY["profile_join"](spark, tables), connect(tables), SQL["profile_join"]) is None


def test_worklist_is_of_customers_without_orders(spark, tables):
    found = {r["row_id"] for r in REGISTRY["fetch_worklist"](spark, tables).collect()}
    assert found and found <= set(range(30, 36))
    assert difference(REGISTRY["fetch_worklist"](spark, tables), connect(tables), SQL["fetch_worklist"]) is None


def test_summary_counts_all_customers_with_orders(spark, tables):
    found = {r["stage"]: r["rows"] for r in REGISTRY["universe_match_summary"](spark, tables).collect()}
    assert found["started"] == 40 and found["matched"] == 33 and 0 < found["kept"] < 33
    assert difference(REGISTRY["universe_match_summary"](spark, tables), connect(tables), SQL["universe_match_summary"]) is None
