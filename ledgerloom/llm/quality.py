"""Quality classifier: naive Bayes support vectors.

A text's features are its n-grams, present or not, scaled by the log ratio of their smoothed class shares and brought
to unit length. A linear model with hinge loss is fitted to them by dual coordinate descent, and its margin
becomes a probability by a logistic curve fitted to margins of rows that did not train the model behind them. The fit
runs in one task on a bounded sample (``per_class`` rows of each label); scores cover all rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ledgerloom.llm.common import crc_fold, ship_code
from ledgerloom.llm.features import SIZE, indicators
from ledgerloom.llm.labelled import training_sample

MODEL = "scale binary, weight binary, bias double, slope double, shift double"


def log_ratios(rows: list[np.ndarray], good: np.ndarray, alpha: float = 1.0, least: int = 3) -> np.ndarray:
    """Log ratio of each feature's smoothed share in good and in bad rows; 0 for features of under ``least`` rows."""
    p, q = (np.bincount(np.concatenate([r for r, y in zip(rows, good) if y == v]), minlength=SIZE).astype(float) for v in (True, False))
    ratio = np.log((p + alpha) / (p + alpha).sum()) - np.log((q + alpha) / (q + alpha).sum())
    return np.where(p + q >= least, ratio, 0.0)


def dual_descent(rows: list[np.ndarray], values: list[np.ndarray], good: np.ndarray, cost: float, rounds: int, seed: int):
    """Weights and bias of the hinge-loss model: each step solves one row's dual variable exactly."""
    rng = np.random.default_rng(seed)
    sign = np.where(good, 1.0, -1.0)
    weight, bias = np.zeros(SIZE), 0.0
    alpha = np.zeros(len(rows))
    curve = np.array([(v * v).sum() + 1.0 for v in values])
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            gradient = sign[i] * (weight[rows[i]] @ values[i] + bias) - 1.0
            new = min(max(alpha[i] - gradient / curve[i], 0.0), cost)
            step = (new - alpha[i]) * sign[i]
            if step:
                weight[rows[i]] += step * values[i]
                bias += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-3 * cost:
            break
    return weight, bias


def scaled(rows: list[np.ndarray], ratio: np.ndarray) -> list[np.ndarray]:
    out = []
    for r in rows:
        v = ratio[r]
        out.append((v / max(np.sqrt((v * v).sum()), 1e-12)).astype(np.float32))
    return out


def _train(rows: list[np.ndarray], good: np.ndarray, seed: int):
    ratio = log_ratios(rows, good)
    weight, bias = dual_descent(rows, scaled(rows, ratio), good, 1.0, 20, seed)
    return ratio, weight, bias


def _curve(margin: np.ndarray, good: np.ndarray, importance: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through margins, by Newton's method with smoothed targets."""
    up, down = importance[good].sum(), importance[~good].sum()
    target = np.where(good, (up + 1) / (up + 2), 1 / (down + 2))
    x = np.stack([margin, np.ones_like(margin)], 1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (importance * (p - target)) + 1e-3 * beta
        hessian = (x * (importance * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(beta[0]), float(beta[1])


def fit(rows: list[np.ndarray], good: np.ndarray, rates: dict[int, float]) -> tuple[np.ndarray, np.ndarray, float, float, float]:
    """Scale, weight, bias, slope and shift. One class alone, or none, gives a constant score."""
    if good.all() or not good.any():
        share = 0.5 if not len(good) else (0.999 if good[0] else 0.001)
        return np.zeros(SIZE), np.zeros(SIZE), 0.0, 0.0, float(np.log(share / (1 - share)))
    fold = np.arange(len(rows)) % 3
    margin = np.zeros(len(rows))
    for f in range(3):
        inner = [r for r, g in zip(rows, fold) if g != f]
        if good[fold != f].all() or not good[fold != f].any():
            continue
        ratio, weight, bias = _train(inner, good[fold != f], f)
        outer = [r for r, g in zip(rows, fold) if g == f]
        margin[fold == f] = [weight[r] @ v + bias for r, v in zip(outer, scaled(outer, ratio))]
    slope, shift = _curve(margin, good, np.where(good, rates.get(1, 1.0), rates.get(0, 1.0)))
    ratio, weight, bias = _train(rows, good, 7)
    return ratio, weight, bias, slope, shift


def _features(batches):
    for batch in batches:
        slots = [x.tobytes() for x in indicators(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(slots, pa.binary())], names=["label", "slots"])


def _fit(rates: dict[int, float]):
    def run(batches):
        labels, rows = [], []
        for batch in batches:
            labels += batch.column("label").to_pylist()
            rows += [np.frombuffer(x, np.int32) for x in batch.column("slots").to_pylist()]
        order = sorted(range(len(rows)), key=lambda i: (labels[i], rows[i].tobytes()))  # the same model however rows arrive
        order = np.random.default_rng(11).permutation(np.array(order, np.int64)) if order else []
        good = np.array([labels[i] == 1 for i in order], bool)
        scale, weight, bias, slope, shift = fit([rows[i] for i in order], good, rates)
        row = (scale.astype(np.float32).tobytes(), (scale * weight).astype(np.float32).tobytes(), bias, slope, shift)
        kinds = (pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=[x.split()[0] for x in MODEL.split(", ")])

    return run


def _score(model, column: str):
    def run(batches):
        own = model.value
        square, product = own["scale"] ** 2, own["weight"]
        for batch in batches:
            margins = []
            for slots in indicators(batch.column("text")):
                length = np.sqrt(square[slots].sum(dtype=np.float64))
                margins.append(product[slots].sum(dtype=np.float64) / max(length, 1e-12) + own["bias"])
            value = np.clip(own["slope"] * np.array(margins, np.float64) + own["shift"], -35, 35)
            columns = [*batch.columns, pa.array(1 / (1 + np.exp(-value)))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, column])

    return run


def with_quality(docs: DataFrame, labels: DataFrame, per_class: int = 3000, column: str = "quality_score") -> DataFrame:
    """``docs`` (doc_id, text, any others) with the score of each text as ``column``; a column of that name is replaced."""
    spark = docs.sparkSession
    ship_code(spark)
    plain = docs.drop(column)
    sample, rates = training_sample(
        plain.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), labels, "quality", per_class
    )
    slots = sample.mapInArrow(_features, "label int, slots binary")
    # at most 2 * per_class rows; one task fits the model
    fitted = slots.repartition(1).mapInArrow(_fit(rates), MODEL).first()
    model = spark.sparkContext.broadcast({
        "scale": np.frombuffer(fitted["scale"], np.float32), "weight": np.frombuffer(fitted["weight"], np.float32),
        "bias": fitted["bias"], "slope": fitted["slope"], "shift": fitted["shift"],
    })
    return plain.mapInArrow(_score(model, column), StructType([*plain.schema.fields, StructField(column, DoubleType())]))


def quality_scores(docs: DataFrame, labels: DataFrame, per_class: int = 3000, threshold: float = 0.3) -> DataFrame:
    """Score every text: doc_id, held_out, score (0 to 1), predicted (score >= ``threshold``), one row a row.

    Labels (doc_id, quality 0 or 1) teach only from ids whose crc32 modulo 5 is not 0; the others are held out. A
    score sees the text alone. NULL text is empty, and an empty text is scored by the model's constant. Rows with
    NULL or repeated ids are scored like all others. Without labels every score is 0.5. Extra columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = with_quality(texts, labels, per_class, "score")
    return scored.select(
        "doc_id", (crc_fold() == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
