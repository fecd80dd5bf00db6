"""Registered corpus queries against their SQL twins, and the pipeline stage by stage."""

import os

import pytest
from compare import connect, difference

import __spark_entry__ as contract
import corpus_pipeline
from ledgerloom.llm import packing
from ledgerloom.llm.oracle import SQL
from ledgerloom.llm.queries import REGISTRY

SF_DIR = os.environ.get("LEDGERLOOM_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_all_are_registered():
    assert {*REGISTRY, "pipeline"} <= set(contract.queries())
    assert set(SQL) <= set(contract.oracle_sql())
    assert sorted(int(name[2:].split("_")[0]) for name in REGISTRY) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert difference(REGISTRY[name](spark, SF_DIR), connect(SF_DIR), SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - set(SQL)))
def test_other_queries_cover_the_table(spark, name):
    got = REGISTRY[name](spark, SF_DIR)
    assert got.columns and got.count() > 0
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    if name not in ("op4_compact_windows", "op5_temperature_mix", "op13_variable_grams"):
        assert docs.join(got.select("doc_id"), "doc_id", "left_anti").count() == 0


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, n = docs.columns, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        out.write.mode("overwrite").parquet(path := str(tmp_path / f"stage{len(n)}"))
        docs = spark.read.parquet(path)
        assert docs.columns == columns
        n.append(docs.count())
    assert n[0] > n[1] > n[2] == n[3] <= n[4]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    pieces = last.groupBy("sequence_id").agg({"length": "sum"}).collect()
    assert max(r[1] for r in pieces) <= 1024 and packing.PLACED.split()[0] in last.columns
