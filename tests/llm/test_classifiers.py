"""Quality and toxicity: the fits against their optimum, held-out accuracy, awkward rows."""

import os

import numpy as np
import pytest
from llm_rows import documents

from ledgerloom.llm import features, quality, toxicity
from ledgerloom.llm.common import table

SF_DIR = os.environ.get("LEDGERLOOM_SF_DIR", "/root/testdata/sf0.001")
LARGER = "/root/testdata/sf0.1"


def test_dual_descent_reaches_the_optimum():
    rng = np.random.default_rng(3)
    rows = [np.sort(rng.choice(40, 8, replace=False)).astype(np.int32) for _ in range(60)]
    values = [rng.random(8) / 3 for _ in rows]
    good = np.array([v[0] + 0.2 * rng.random() > 0.25 for v in values])
    weight, bias = quality.dual_descent(rows, values, good, 1.0, 400, 1)
    sign = np.where(good, 1.0, -1.0)

    def loss(w, b):
        margin = np.array([w[r] @ v + b for r, v in zip(rows, values)])
        return 0.5 * (w @ w + b * b) + np.maximum(0, 1 - sign * margin).sum()

    best = loss(weight, bias)
    for _ in range(300):  # no step in any direction helps
        step = np.zeros(features.SIZE)
        step[:40] = rng.normal(0, 0.02, 40)
        assert loss(weight + step, bias + rng.normal(0, 0.02)) > best - 2e-3


def test_ordinal_fit_orders_the_grades():
    rng = np.random.default_rng(5)
    grade = rng.integers(0, 4, 600)
    slots = [np.array([1, 2 + int(rng.integers(0, 30))]) if g else np.array([2 + int(rng.integers(0, 30))]) for g in grade]
    values = [np.array([1.0 * g, 1.0]) if g else np.array([1.0]) for g in grade]
    weight, cuts = toxicity.fit_ordinal(slots, values, grade, np.ones(600), 3)
    assert (np.diff(cuts) > 0).all() and weight[1] > 5 * np.abs(weight[2:32]).max()
    score = np.array([weight[s] @ v for s, v in zip(slots, values)])
    expected = (1 / (1 + np.exp(-(score[:, None] - cuts)))).sum(1)
    assert np.abs(expected - grade).mean() < 0.3


def area(score, label):
    order = np.argsort(np.argsort(score)) + 1
    n = label.sum()
    return (order[label == 1].sum() - n * (n + 1) / 2) / (n * (len(label) - n))


@pytest.mark.skipif(not os.path.isdir(LARGER), reason="no test tables")
def test_held_out_accuracy(spark):
    docs, labels = table(spark, LARGER, "documents"), table(spark, LARGER, "labels")
    scored = quality.quality_scores(docs, labels).join(labels, "doc_id").filter("held_out").toPandas()
    assert area(scored.score.to_numpy(), scored.quality.to_numpy()) > 0.99
    assert (scored.predicted == scored.quality).mean() > 0.97
    graded = toxicity.toxicity_grades(docs, labels).join(labels.withColumnRenamed("toxic", "label"), "doc_id").filter("held_out").toPandas()
    assert area(graded.severity.to_numpy() + 1e-9 * np.arange(len(graded)), graded.label.to_numpy()) > 0.93
    assert (graded.toxic & (graded.label == 0)).sum() <= 0.02 * (graded.label == 0).sum()


AWKWARD = [(1, "good words"), (2, None), (3, ""), (None, "no id"), (1, "good words"), (4, "long " * 40_000)]


@pytest.mark.parametrize("labelled", [[], [(1, 1, 1)], [(1, 1, 0), (4, 0, 1), (1, 0, 1), (None, 1, 1), (9, None, None), (3, 7, 7)]])
def test_awkward_rows_and_labels(spark, labelled):
    labels = spark.createDataFrame(labelled, "doc_id long, quality int, toxic int")
    scored = quality.quality_scores(documents(spark, AWKWARD), labels).collect()
    graded = toxicity.toxicity_grades(documents(spark, AWKWARD), labels).collect()
    want = sorted(str(d) for d, _ in AWKWARD)
    assert sorted(str(r.doc_id) for r in scored) == want == sorted(str(r.doc_id) for r in graded)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in scored)
    assert all(0 <= r.severity <= 3 and r.toxic == (r.grade >= 1) for r in graded)
    assert len({r.score for r in scored if r.doc_id == 1}) == 1
    if not labelled:
        assert {r.score for r in scored} == {0.5} and not any(r.toxic for r in graded)
    empty = documents(spark, AWKWARD).limit(0)
    assert quality.quality_scores(empty, labels).count() == 0 and toxicity.toxicity_grades(empty, labels).count() == 0
