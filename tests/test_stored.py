"""Stored tables: whole replacement, buckets, folds of batches, scoped intermediates, and readers that skip files."""

import os
import random
from datetime import date, timedelta

import pytest
from conftest import document, record, rows, write_json
from pyspark.sql import functions as F

from ledgerloom import session
from ledgerloom.operators import clean, facts, fold
from ledgerloom.sources import documents as docs
from ledgerloom.sources import stored, tables, variants
from ledgerloom.workload import queries

KEYS = ["cik", "tag", "period_end"]


def failing(df):
    return df.withColumn("cash", F.when(F.col("cash") > 1, F.raise_error(F.lit("broken"))).otherwise(F.col("cash")))


def test_a_failed_write_leaves_the_old_panel(spark, tmp_path):
    panel = spark.createDataFrame([("A", 2020, 1.0), ("B", 2021, 1.0)], "ticker string, fiscal_year int, cash double")
    new = spark.createDataFrame([("C", 2022, 5.0)], "ticker string, fiscal_year int, cash double")
    for write, read in ((tables.write_panel, spark.read.parquet), (tables.write_csv, lambda p: spark.read.option("header", True).csv(p))):
        path = str(tmp_path / write.__name__)
        write(panel, path)
        with pytest.raises(Exception, match="broken"):
            write(failing(new), path)
        assert rows(read(path).select("ticker"), "ticker") == [("A",), ("B",)]
        write(new, path)
        assert rows(read(path).select("ticker")) == [("C",)]
        assert [name for name in os.listdir(tmp_path) if ".new-" in name or ".old-" in name] == []


def test_bucketed_tables_need_no_shuffle(spark):
    rows_ = spark.range(4000).select((F.col("id") % 37).alias("cik"), F.col("id").alias("period_end"), F.when(F.col("id") % 3 == 0, F.col("id") * 1.0).alias("cash"))
    stored.store_bucketed(rows_, "bucketed_test", ["cik"], 8, ["period_end"])
    try:
        table = spark.table("bucketed_test")
        other = table.groupBy("cik").agg(F.max("cash").alias("most"))
        filled = clean.forward_fill(table, ["cash"], entity="cik").join(other.hint("merge"), "cik")
        text = filled._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in text and "Bucketed: true" in text
        assert filled.count() == 4000
        stored.store_bucketed(rows_.limit(10), "bucketed_test", ["cik"], 8)
        assert spark.table("bucketed_test").count() == 10 and len(stored.versions(spark, "bucketed_test")) == 1
    finally:
        stored.drop_stored(spark, "bucketed_test")
    assert not spark.catalog.tableExists("bucketed_test")


def random_facts(n=600, seed=4):
    rng = random.Random(seed)
    out = []
    for pos in range(n):
        filed = None if rng.random() < 0.1 else date(2020, 1, 1) + timedelta(days=rng.randrange(40))
        out.append((rng.randrange(9), rng.choice(["Assets", "Cash"]), date(2019, 12, 31 - rng.randrange(3)), filed, rng.choice([None, float(pos)]), pos, pos % 3))
    return out


SCHEMA = "cik long, tag string, period_end date, filed date, val double, pos long, priority int"


@pytest.mark.parametrize("lead", [None, "priority"])
def test_batches_in_any_order_fold_to_the_same(spark, lead):
    data = random_facts()
    whole = spark.createDataFrame(data, SCHEMA)
    want = rows(facts.latest_filing(whole, KEYS, ["val"], lead=lead).select(*KEYS, "filed", "val"), *KEYS)
    for seed in (1, 2):
        mixed = random.Random(seed).sample(data, len(data))
        table = fold.FoldTable(spark, f"fold_test_{seed}", KEYS, ["val"], buckets=4, lead=lead)
        try:
            batches = [mixed[i::4] for i in range(4)]
            for batch in [*batches, batches[1]]:  # one comes twice
                table.merge(spark.createDataFrame(batch, SCHEMA))
            assert rows(table.latest().select(*KEYS, "filed", "val"), *KEYS) == want
            assert len(stored.versions(spark, table.name)) == 1
        finally:
            table.drop()


def test_a_merge_does_not_shuffle_the_state(spark):
    table = fold.FoldTable(spark, "fold_plan_test", KEYS, ["val"], buckets=4)
    try:
        table.merge(spark.createDataFrame(random_facts(), SCHEMA))
        batch = session.cut_lineage(fold.fold(spark.createDataFrame(random_facts(50, 9), SCHEMA), KEYS, ["val"]))
        text = table.joined(batch)._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange") == 1 and "Bucketed: true" in text
    finally:
        table.drop()


def test_keys_and_empty_batches(spark):
    table = fold.FoldTable(spark, "fold_empty_test", KEYS, ["val"], buckets=2)
    empty = spark.createDataFrame([], SCHEMA)
    try:
        table.merge(empty)
        assert table.latest().count() == 0
        table.merge(spark.createDataFrame([(1, "A", None, None, 1.0, 1, 0), (1, "A", date(2020, 1, 1), None, 2.0, 2, 0)], SCHEMA))
        table.merge(empty)
        assert [r.val for r in table.latest().collect()] == [2.0]
    finally:
        table.drop()


def test_intermediates_go_when_their_block_ends(spark):
    before = session.cut_lineage(spark.range(3))
    with session.intermediates(spark):
        inner = session.cut_lineage(spark.range(5))
        assert inner.count() == 5
        folder = inner.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
        assert os.path.isdir(folder)
    assert not os.path.exists(folder) and before.count() == 3


def files_read(df):
    """How many files the scan of a finished plan opened."""
    df.collect()
    leaves, found = df._jdf.queryExecution().executedPlan().collectLeaves(), []
    for i in range(leaves.size()):
        metric = leaves.apply(i).metrics().get("numFiles")
        found += [metric.get().value()] if metric.isDefined() else []
    return found


def test_unwanted_files_are_not_opened(spark, tmp_path):
    for i in range(20):
        write_json(tmp_path, f"CIK{i:010d}.json", {"name": f"Company {i}", "tickers": ["T"]})
    wanted = spark.createDataFrame([("0000000003",), ("0000000007",), ("99",), (None,)], "cik string")
    read = docs.read_submissions(spark, str(tmp_path), wanted)
    assert files_read(read) == [2] and rows(read.select("cik_key"), "cik_key") == [("3",), ("7",)]
    assert files_read(docs.read_submissions(spark, str(tmp_path))) == [20]
    assert docs.read_submissions(spark, str(tmp_path), wanted.limit(0)).count() == 0
    assert docs.listed_files(spark, str(tmp_path)).where("length > 0").count() == 20


def test_documents_of_listed_companies_only(spark, tmp_path):
    for name in ("AAA", "BBB", "CCC"):
        write_json(tmp_path, f"{name}.json", document(1, name, {"Assets": {"USD": [record("2020-12-31", 5)]}}))
    wanted = spark.createDataFrame([("BBB",), ("ZZZ",)], "ticker string")
    assert rows(docs.read_fact_documents(spark, str(tmp_path), wanted).select("ticker")) == [("BBB",)]


def test_variants_keep_what_a_schema_loses(spark, tmp_path):
    body = document(12, "Odd", {"Assets": {"EUR": [record("2020-12-31", "7.5"), record("no day", {"a": 1}), 3], "USD": [record("2020-12-31", True)]}})
    body["facts"]["ifrs-full"] = {"Equity": {"label": 5, "units": {"shares": "none"}}, "Wrong": 4}
    body["facts"]["note"] = "text"
    write_json(tmp_path, "ODD.json", body)
    write_json(tmp_path, "BAD.json", "{ not json")
    write_json(tmp_path, "LIST.json", [1, 2])
    texts = docs.read_texts(spark, str(tmp_path)).withColumn("ticker", F.regexp_replace("file_name", r"\.json$", ""))
    parsed = variants.parse_variants(texts)
    got = variants.flatten_variants(parsed).select("ticker", "cik", "tag", "unit", "unit_pos", "pos", "period_end", "val", "raw_val")
    day = date(2020, 12, 31)
    assert rows(got, "unit", "pos") == [
        ("ODD", "0000000012", "Assets", "EUR", 0, 0, day, 7.5, None), ("ODD", "0000000012", "Assets", "EUR", 0, 1, None, None, '{"a":1}'),
        ("ODD", "0000000012", "Assets", "EUR", 0, 2, None, None, None), ("ODD", "0000000012", "Assets", "USD", 1, 0, day, None, "true"),
    ]
    chosen = variants.flatten_variants(parsed, tags=["Assets", "Equity"], unit_preference=("shares", "USD"))
    assert rows(chosen.select("tag", "unit", "raw_val")) == [("Assets", "USD", "true")]


def test_truth_values_and_records_of_the_wrong_kind(spark):
    records = '[{"val":1,"end":5},{"val":true},{"val":false},{"val":"0"},{"val":null},7,{"val":1e0,"form":2}]'
    text = '{"cik":3,"facts":{"g":{"T":{"units":{"b":' + records + ',"a":{},"c":[[]]}}}}}'
    parsed = variants.parse_variants(spark.createDataFrame([("X", text)], "ticker string, text string"))
    got = variants.flatten_variants(parsed).select("unit", "unit_pos", "pos", "period_end", "val", "form", "raw_val")
    assert [tuple(r) for r in got.orderBy("unit", "pos").collect()] == [
        ("b", 1, 0, None, 1.0, None, None),
        ("b", 1, 1, None, None, None, "true"),
        ("b", 1, 2, None, None, None, "false"),
        ("b", 1, 3, None, 0.0, None, None),
        ("b", 1, 4, None, None, None, None),
        ("b", 1, 5, None, None, None, None),
        ("b", 1, 6, None, 1.0, "2", None),
        ("c", 2, 0, None, None, None, None),
    ]


def test_buckets_grow_with_the_rows(spark, tmp_path, monkeypatch):
    assert [stored.bucket_count(n) for n in (0, 2_000_000, 25_000_000)] == [8, 8, 100]
    day = "timestamp'1995-02-01' + make_interval(0, 0, 0, cast(id % 900 as int))"
    lines = spark.range(1000).selectExpr(
        "id as l_orderkey", "id % 7 as l_partkey", "id % 5 as l_suppkey", "1 as l_linenumber", "'A' as l_returnflag",
        "'F' as l_linestatus", f"{day} as l_shipdate", "cast(id as double) as l_extendedprice",
    )
    orders = spark.range(1000).selectExpr(
        "id as o_orderkey", "id % 40 as o_custkey", "'2-HIGH' as o_orderpriority", "'F' as o_orderstatus", f"{day} as o_orderdate"
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    used, keep = [], fold.FoldTable.__init__

    def seen(self, spark, name, keys, carry, buckets, **rest):
        used.append(buckets)
        keep(self, spark, name, keys, carry, buckets, **rest)

    monkeypatch.setattr(fold.FoldTable, "__init__", seen)
    monkeypatch.setattr(stored, "BUCKET_ROWS", 100)
    found = queries.latest_filing_in_batches(spark, str(tmp_path))
    assert used == [10]
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, queries.latest_filing(spark, str(tmp_path)).select(*found.columns).collect()))
