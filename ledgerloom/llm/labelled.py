"""A bounded sample of labelled documents, with folds that keep some documents out of training."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import crc_fold, written


def training_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> tuple[DataFrame, dict[int, float]]:
    """(label, text) of at most ``per_class`` training ids a class, and each class's ids in all per id taken.

    Only ids with crc32(id as text) mod 5 other than 0 are taken, those of smallest hash first. Ids that are NULL,
    without a label or with contradicting labels are left out. The sample's ids are few and bounded, so they are
    broadcast; a document that occurs in several rows counts with each.
    """
    clean = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .filter("doc_id is not null and label in (0, 1)")
        .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .filter("label = other").filter(crc_fold() != 0).select("doc_id", "label")
    )
    clean = written(clean)
    sizes = {r["label"]: r["n"] for r in clean.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    taken = None
    for value in sorted(sizes):
        own = clean.filter(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        taken = own if taken is None else taken.union(own)
    if taken is None:
        return clean.select("label", F.lit("").alias("text")).limit(0), {}
    rates = {value: n / min(n, per_class) for value, n in sizes.items()}
    taken = written(taken)
    return docs.select("doc_id", "text").join(F.broadcast(taken), "doc_id").select("label", "text"), rates
