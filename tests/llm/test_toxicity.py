import math
import random

import numpy as np
import pytest

from wearlens.llm import toxicity


@pytest.fixture(scope="module")
def labelled(spark, words):
    """Half of the documents carry labels; toxic ones hold a stem with changing endings."""
    rows, labels = [], []
    for k in range(1200):
        w = words(30 + k % 200, k)
        toxic = k % 8 == 0
        if toxic:
            for p in range(0, len(w), 10 if k % 16 else 30):
                w[p] = f"vile{k % 13}x{p % 7}"
        rows.append((k, " ".join(w)))
        if k % 2 == 0 or not toxic:
            labels.append((k, int(toxic)))
    return rows, [x for x in labels if x[0] < 800]


def test_held_out_documents(spark, documents, labelled):
    rows, labels = labelled
    model = toxicity.train(documents(*rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r.doc_id: r for r in toxicity.score(documents(*rows), model).collect()}
    for k in range(800, 1200):
        assert got[k].kept == (k % 8 != 0)
        assert abs(got[k].expected_severity - (got[k].p_toxic + (got[k].expected_severity - got[k].p_toxic))) < 1e-12
    dense = [got[k].expected_severity for k in range(800, 1200, 8) if k % 16]
    sparse = [got[k].expected_severity for k in range(800, 1200, 16)]
    assert not dense or np.mean(dense) > np.mean(sparse)


def test_fit_orders_thresholds_and_shares_weights():
    r = np.random.default_rng(0)
    x = r.random((4000, 3)) < 0.4
    score = x @ np.array([2.0, -1.0, 0.0])
    grade = (score + r.logistic(size=4000) > 0.5).astype(int) + (score + r.logistic(size=4000) > 2.5)
    grade = np.minimum(grade, 2)
    at = np.argwhere(x)
    weights, thresholds = toxicity.fit(at[:, 0], at[:, 1], grade, 3)
    assert thresholds[0] < thresholds[1]
    assert abs(weights[0] - 2) < 0.5 and abs(weights[1] + 1) < 0.5 and abs(weights[2]) < 0.3
    model = toxicity.Model(np.arange(3, dtype=np.uint64), weights, weights * 0, thresholds)
    assert np.allclose(model.above(np.array([thresholds[0]]))[:, 0], 0.5)


def test_missing_labels_texts_and_rows(spark, documents):
    docs = documents((1, None), (2, ""), (None, "some words"), (3, "x"), (3, "x"))
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    for labels in (empty, spark.createDataFrame([(1, None), (None, 1), (2, 0)], "doc_id long, toxic int")):
        model = toxicity.train(docs, labels)
        rows = toxicity.score(docs, model).collect()
        assert len(rows) == 5 and all(r.kept and r.expected_severity == 0 for r in rows)
        assert toxicity.drop_toxic(docs, labels).count() == 5
    assert toxicity.train(documents(), empty).thresholds[0] == np.inf


def test_rejected_documents_go_and_others_keep_all_columns(spark, documents, labelled):
    rows, labels = labelled
    docs = documents(*rows, (None, rows[0][1]))
    left = toxicity.drop_toxic(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert left.schema == docs.schema
    assert {r.doc_id for r in left.select("doc_id").collect()} == {k for k in range(1200) if k % 8}


def test_fit_equals_a_plain_search_on_few_rows():
    """The same likelihood written row by row, minimized one parameter at a time."""
    r = random.Random(12)
    present, grade = [], []
    for _ in range(50):
        x = [k for k in range(3) if r.random() < 0.5]
        s = 1.5 * (0 in x) - 1.0 * (1 in x) + r.gauss(0, 1.2)
        present.append(x)
        grade.append(0 if s < 0 else 1 if s < 1.2 else 2)

    def sigmoid(x):
        return 1 / (1 + math.exp(-x))

    def loss(v):  # three weights, two thresholds
        if v[3] >= v[4]:
            return math.inf
        total = 0.0
        for x, g in zip(present, grade):
            s = sum(v[k] for k in x)
            low, high = (0.0 if g == 0 else sigmoid(v[2 + g] - s)), (1.0 if g == 2 else sigmoid(v[3 + g] - s))
            total -= math.log(max(high - low, 1e-12))
        return total / len(grade) + toxicity.RIDGE / 2 * sum(w * w for w in v[:3])

    v = [0.0, 0.0, 0.0, 0.0, 1.0]
    for _ in range(60):
        for i in range(5):
            lo, hi = v[i] - 2, v[i] + 2
            while hi - lo > 1e-7:  # the loss is convex in each parameter
                a, b = lo + (hi - lo) / 3, hi - (hi - lo) / 3
                if loss(v[:i] + [a] + v[i + 1 :]) < loss(v[:i] + [b] + v[i + 1 :]):
                    hi = b
                else:
                    lo = a
            v[i] = (lo + hi) / 2
    rows = np.repeat(np.arange(50), [len(x) for x in present])
    weights, thresholds = toxicity.fit(rows, np.array([k for x in present for k in x]), np.array(grade), 3)
    assert loss([*weights, *thresholds]) <= loss(v) + 1e-9
    assert np.allclose([*weights, *thresholds], v, atol=2e-3)
