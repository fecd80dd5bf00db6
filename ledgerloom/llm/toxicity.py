"""Toxicity: cumulative-link ordinal regression on sparse word features.

P(grade >= k) = sigmoid(w . x - cut_k): one weight vector for all grades and an ascending cut for each. Features are
the logarithms of word counts. The result is the expected grade, the sum of those probabilities.

Labels only say toxic or not. Grades above 1 come from how many occurrences a toxic text has of words marked by the
labels themselves: words and word beginnings that occur in several toxic training texts and hardly in others. The fit runs in
one task on a bounded sample; scores cover all rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import crc_fold, ship_code
from ledgerloom.llm.features import SIZE, word_counts
from ledgerloom.llm.labelled import training_sample

# Marked occurrences, up to three for one word, from which a toxic text has grade 2 and grade 3.
STEPS = (7, 16)
MODEL = "weight binary, cuts binary"


def marked_words(slots: list[np.ndarray], toxic: np.ndarray, least: int = 3, odds: float = 8.0) -> np.ndarray:
    """Which slots occur in at least ``least`` toxic texts and ``odds`` times more often there than in others."""
    p, q = (np.bincount(np.concatenate([s for s, y in zip(slots, toxic) if y == v] or [np.zeros(0, np.int64)]), minlength=SIZE) for v in (True, False))
    share = (p + 0.5) / (toxic.sum() + 1) / ((q + 0.5) / ((~toxic).sum() + 1))
    return (p >= least) & (share >= odds)


def telling(slots: list[np.ndarray], toxic: np.ndarray, least: int, odds: float = 2.0) -> np.ndarray:
    """Which slots occur in ``least`` texts and ``odds`` times more often in one class than in the other."""
    p, q = (np.bincount(np.concatenate([s for s, y in zip(slots, toxic) if y == v]), minlength=SIZE) for v in (True, False))
    share = (p + 0.5) / (toxic.sum() + 1) / ((q + 0.5) / ((~toxic).sum() + 1))
    return (p + q >= least) & ((share >= odds) | (share <= 1 / odds))


def grades(slots: list[np.ndarray], counts: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """0 for clean texts, 1 to 3 for toxic ones by their marked occurrences."""
    marked = marked_words(slots, toxic)
    hits = np.array([int(c[marked[s]].sum()) for s, c in zip(slots, counts)])
    return np.where(toxic, 1 + sum((hits >= step).astype(int) for step in STEPS), 0)


def fit_ordinal(slots, values, grade, importance, levels: int, rounds: int = 300, penalty: float = 2e-5):
    """Weights and ascending cuts by gradient steps with per-coordinate rates (Adam) on the cumulative likelihood."""
    used, place = np.unique(np.concatenate(slots), return_inverse=True)
    rows = np.repeat(np.arange(len(slots)), [len(s) for s in slots])
    x = np.concatenate(values)
    n = importance.sum()
    # cuts are a first one and positive gaps
    theta = np.concatenate([np.zeros(len(used)), [1.0], np.zeros(levels - 1)])
    one, two = np.zeros_like(theta), np.zeros_like(theta)
    k = np.arange(levels)

    def sigmoid(z):
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))

    for step in range(1, rounds + 1):
        w = theta[: len(used)]
        gaps = np.exp(theta[len(used) + 1 :])
        cuts = theta[len(used)] + np.concatenate([[0.0], np.cumsum(gaps)])
        score = np.bincount(rows, w[place] * x, len(slots))
        above = np.concatenate([np.ones((len(score), 1)), sigmoid(score[:, None] - cuts), np.zeros((len(score), 1))], 1)
        own = np.arange(len(score))
        high, low = above[own, grade], above[own, grade + 1]
        p = np.maximum(high - low, 1e-12)
        slope_high, slope_low = high * (1 - high), low * (1 - low)
        slope_high[grade == 0] = 0
        slope_low[grade == levels] = 0
        outer = -importance * (slope_high - slope_low) / p / n
        by_cut = np.zeros(levels)
        np.add.at(by_cut, grade[grade > 0] - 1, (importance * slope_high / p)[grade > 0] / n)
        np.add.at(by_cut, grade[grade < levels], -(importance * slope_low / p)[grade < levels] / n)
        gradient = np.concatenate([
            np.bincount(place, outer[rows] * x, len(used)) + penalty * w, [by_cut.sum()],
            [by_cut[j:].sum() * gaps[j - 1] for j in k[1:]],
        ])
        one, two = 0.9 * one + 0.1 * gradient, 0.99 * two + 0.01 * gradient**2
        rate = 0.1 * (1 - (step - 1) / rounds)
        theta -= rate * (one / (1 - 0.9**step)) / (np.sqrt(two / (1 - 0.99**step)) + 1e-8)
    weight = np.zeros(SIZE)
    weight[used] = theta[: len(used)]
    return weight, theta[len(used)] + np.concatenate([[0.0], np.cumsum(np.exp(theta[len(used) + 1 :]))])


def _features(batches):
    for batch in batches:
        both = [(s.astype(np.int32).tobytes(), c.astype(np.int32).tobytes()) for s, c in word_counts(batch.column("text"))]
        slots, counts = zip(*both) if both else ((), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column("label"), pa.array(slots, pa.binary()), pa.array(counts, pa.binary())], names=["label", "slots", "counts"]
        )


def train(slots: list[np.ndarray], counts: list[np.ndarray], toxic: np.ndarray, rates: dict[int, float], least: int = 3):
    """Weights and cuts; without examples of both labels everything scores as clean as the labels say."""
    levels = len(STEPS) + 1
    if not len(toxic) or toxic.all() or not toxic.any():
        high = -10.0 if len(toxic) and toxic.all() else 10.0
        return np.zeros(SIZE), high + np.arange(levels)
    grade = grades(slots, counts, toxic)
    support = telling(slots, toxic, least)
    kept = [support[s] for s in slots]
    values = [np.log1p(c[k]) for c, k in zip(counts, kept)]
    importance = np.where(toxic, rates.get(1, 1.0), rates.get(0, 1.0))
    return fit_ordinal([s[k] for s, k in zip(slots, kept)], values, grade, importance, levels)


def _fit(rates: dict[int, float]):
    def run(batches):
        rows = sorted(tuple(r.values()) for batch in batches for r in batch.to_pylist())
        slots = [np.frombuffer(r[1], np.int32).astype(np.int64) for r in rows]
        counts = [np.frombuffer(r[2], np.int32).astype(np.int64) for r in rows]
        weight, cuts = train(slots, counts, np.array([r[0] == 1 for r in rows], bool), rates)
        yield pa.RecordBatch.from_arrays(
            [pa.array([weight.astype(np.float32).tobytes()], pa.binary()), pa.array([cuts.astype(np.float64).tobytes()], pa.binary())],
            names=["weight", "cuts"],
        )

    return run


def _score(model):
    def run(batches):
        weight, cuts = model.value["weight"], model.value["cuts"]
        for batch in batches:
            score = np.array([(weight[s] * np.log1p(c)).sum(dtype=np.float64) for s, c in word_counts(batch.column("text"))], np.float64)
            above = 1 / (1 + np.exp(-np.clip(score[:, None] - cuts, -35, 35)))
            grade = (above >= 0.5).sum(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(above.sum(1)), pa.array(above[:, 0]), pa.array(grade.astype(np.int32))],
                names=["doc_id", "severity", "p_toxic", "grade"],
            )

    return run


def toxicity_grades(docs: DataFrame, labels: DataFrame, per_class: int = 6000) -> DataFrame:
    """Grade every text: doc_id, held_out, severity (expected grade, 0 to 3), p_toxic, grade, toxic (grade >= 1).

    Labels (doc_id, toxic 0 or 1) teach only from ids whose crc32 modulo 5 is not 0. NULL text is empty and scores
    by the cuts alone. Rows with NULL or repeated ids are graded like all others; extra columns are ignored.
    Without toxic labels every text is clean.
    """
    spark = docs.sparkSession
    ship_code(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sample, rates = training_sample(texts, labels, "toxic", per_class)
    rows = sample.mapInArrow(_features, "label int, slots binary, counts binary")
    # at most 2 * per_class rows; one task fits the model
    fitted = rows.repartition(1).mapInArrow(_fit(rates), MODEL).first()
    model = spark.sparkContext.broadcast({"weight": np.frombuffer(fitted["weight"], np.float32), "cuts": np.frombuffer(fitted["cuts"], np.float64)})
    scored = texts.mapInArrow(_score(model), "doc_id long, severity double, p_toxic double, grade int")
    return scored.select("doc_id", (crc_fold() == 0).alias("held_out"), "severity", "p_toxic", "grade", (F.col("grade") >= 1).alias("toxic"))
