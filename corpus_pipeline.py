"""Training-data pipeline: stages over ``documents``, each written and read again as the next one's input.

Each stage takes (spark, docs, sf_dir) and works on all documents its predecessor kept. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import free_name, table, written
from ledgerloom.llm.mixing import mixed
from ledgerloom.llm.packing import pack
from ledgerloom.llm.partenum import one_of_each_component, text_digest
from ledgerloom.llm.pseudonyms import pseudonymised
from ledgerloom.llm.quality import with_quality

# The stages fit models, permute by keys and tokenise, which SQL cannot express.
ORACLE_SQL = None

KEY = b"key of the pipeline"


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; its labels come from the table ``labels``."""
    score = free_name(docs, "quality_score_of_text")
    scored = with_quality(docs, table(spark, sf_dir, "labels"), column=score)
    return scored.filter(F.col(score) >= 0.3).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8 or more, keep the one with the smallest id.

    Of several rows with that id and text one stays; other texts of the id are judged by themselves. Rows without an
    id stay.
    """
    names = free_name(docs, "kept_id"), free_name(docs, "kept_digest")
    kept = one_of_each_component(docs, k=5, percent=80).toDF(*names)
    same = (F.col("doc_id") == F.col(names[0])) & (text_digest() == F.col(names[1]))
    return docs.join(kept, same, "left_semi").dropDuplicates(["doc_id", "text"]).union(docs.filter("doc_id is null"))


def without_private_values(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Private numbers, dates, addresses and keys replaced by pseudonyms of their format."""
    return pseudonymised(docs, KEY, kinds=free_name(docs, "private_kinds")).select(*docs.columns)


def temperature_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources repeated up to 1.5 times; the budget covers every source, so no document is lost."""
    names = {"block": free_name(docs, "mix_block"), "position": free_name(docs, "mix_position")}
    return mixed(docs, repeats=1.5, budget=None, **names).select(*docs.columns)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences of 1024 ids."""
    return pack(docs, end_id=2, tokens=1024)


STAGES = [
    ("quality_classifier", good_documents),
    ("jaccard_join", one_of_each_group),
    ("pii", without_private_values),
    ("temperature_mix", temperature_mix),
    ("best_fit_packing", packed_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; what a stage returns is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
