"""The registered queries of this subpackage: thin digests over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import table
from ledgerloom.llm.mixing import mixed
from ledgerloom.llm.negatives import hard_negatives
from ledgerloom.llm.packing import pack
from ledgerloom.llm.partenum import jaccard_join
from ledgerloom.llm.passages import repeated_passages
from ledgerloom.llm.phrases import contaminated, lowered
from ledgerloom.llm.pq import near_duplicates
from ledgerloom.llm.pseudonyms import pseudonymised
from ledgerloom.llm.quality import quality_scores
from ledgerloom.llm.spelling import spelling_variants
from ledgerloom.llm.topk import top_k
from ledgerloom.llm.toxicity import toxicity_grades
from ledgerloom.llm.wavelet import read_documents, write_shards

# The key of the registered query; a user passes a secret one.
KEY = b"key of the registered query"


def op1_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place, length and checksum, as read back from the written wavelet shards."""
    return read_documents(write_shards(table(spark, sf_dir, "documents"), end_id=0))


def op2_branch_and_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five largest integer inner products of every 50th vector against all others."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256.0)


def op3_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's expected severity and grade."""
    return toxicity_grades(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that two documents share."""
    return repeated_passages(table(spark, sf_dir, "documents"))


def op5_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus mixed to 95 % of the largest source entropy, at most 4 readings a source, at its own token budget."""
    chosen = mixed(table(spark, sf_dir, "documents"), entropy=0.95, repeats=4.0, budget=1.0)
    return chosen.select("doc_id", "source", "mix_block", "mix_position")


def op6_product_quantisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's links and component at a cosine of 0.95."""
    return near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.95)


def op7_quality_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


def op8_feistel_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its private values replaced by format-preserving pseudonyms."""
    hidden = pseudonymised(table(spark, sf_dir, "documents"), KEY)
    return hidden.select("doc_id", "text", F.size("private_kinds").alias("n_private"))


def op9_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of at most 1024 ids."""
    return pack(table(spark, sf_dir, "documents"), end_id=2, tokens=1024)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's set size and component under 4-word shingles and a similarity of 0.85."""
    return jaccard_join(table(spark, sf_dir, "documents"), k=4, percent=85)[0]


def op11_threshold_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten hard negatives for each of the five positives of every 100th vector; each seventh label is off by one."""
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = vectors.select("vec_id", "embedding", label.alias("label"))
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0, positives=5, negatives=10, low=30, high=90, scale=256.0)


def op12_inverted_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words inside ten-word windows of benchmark items, and the items found."""
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), length=10)
    digest = F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, (F.col("n_hit") > 0).alias("contaminated"))


def op13_variable_grams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word with its near words and the form it is a variant of.

    One of 199 runs, by the checksum of document and run, loses a letter first.
    """
    docs = table(spark, sf_dir, "documents")
    pieces = F.split(lowered(F.col("text")), "[^a-z\u00C0-\u00FF]+")
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(pieces).alias("run"))
    runs = runs.filter(F.length("run") >= 6)
    checksum = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = F.pmod(checksum, F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    kept = runs.select(F.when(checksum % 199 == 0, shorter).otherwise(F.col("run")).alias("word")).filter(F.length("word") >= 6)
    return spelling_variants(kept.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter("n >= 5"), ratio=5)


REGISTRY = {
    "op1_wavelet_tokens": op1_wavelet_tokens,
    "op2_branch_and_bound": op2_branch_and_bound,
    "op3_ordinal_toxicity": op3_ordinal_toxicity,
    "op4_compact_windows": op4_compact_windows,
    "op5_temperature_mix": op5_temperature_mix,
    "op6_product_quantisation": op6_product_quantisation,
    "op7_quality_nbsvm": op7_quality_nbsvm,
    "op8_feistel_pii": op8_feistel_pii,
    "op9_vector_packing": op9_vector_packing,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_threshold_negatives": op11_threshold_negatives,
    "op12_inverted_index": op12_inverted_index,
    "op13_variable_grams": op13_variable_grams,
}
