"""Every registered query against its SQL twin, and the shape of the plans."""

import os
import re

import pytest
from compare import connect, difference

import __spark_entry__ as contract
from ledgerloom.operators.dedupe import keep_most_complete
from ledgerloom.workload import views
from ledgerloom.workload.oracle import SQL
from ledgerloom.workload.queries import REGISTRY

SF_DIR = os.environ.get("LEDGERLOOM_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = REGISTRY, SQL

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.keys() <= contract.queries().keys() and ORACLES.keys() <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


def test_entry_returns_rows(spark):
    assert contract.entry(spark).limit(1).count() == 1


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


PLAIN = ["ratios_quarterly", "three_statement_join", "ffill", "dedupe_complete", "snapshot_last_non_null", "annual_panel"]


@pytest.mark.parametrize("name", PLAIN)
def test_plans_stay_in_the_jvm_without_cross_joins(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "Python" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_dedupe_limits_groups_before_the_shuffle(spark):
    orders = views.table(spark, SF_DIR, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    text = plan(keep_most_complete(orders, ["o_custkey"], ["o_orderdate"]))
    assert re.search(r"WindowGroupLimit .*Partial", text)


def test_latest_filing_combines_before_the_shuffle(spark):
    text = plan(views.latest(spark, SF_DIR))
    assert "partial_max_by" in text and "SortAggregate" not in text


@pytest.mark.parametrize("name", ["latest_filing", "preferred_unit", "fallback_period", "fallback_entity"])
def test_facts_are_resolved_in_hash_tables(spark, name):
    assert "SortAggregate" not in plan(QUERIES[name](spark, SF_DIR))


def test_scan_reads_only_needed_columns(spark):
    text = plan(QUERIES["value_counts"](spark, SF_DIR))
    assert "l_comment" not in text and "o_totalprice" not in text and "PushedFilters: [IsNotNull(o_orderpriority)" in text


def test_forward_fill_of_all_columns_is_one_window(spark):
    text = plan(QUERIES["ffill"](spark, SF_DIR))
    assert len(re.findall(r"^\W*Window ", text, re.M)) == 1


def test_odd_documents_are_put_together_within_a_filer(spark):
    """The lines are dealt by filer once; no grouping deals the growing texts again."""
    text = plan(views.odd_fact_texts(spark, SF_DIR))
    dealt = re.findall(r"Exchange hashpartitioning\((cik[^)]*)\)", text)
    assert len(dealt) == 1 and dealt[0].count("#") == 1
