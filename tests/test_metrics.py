import numpy as np
import pytest
from pyspark.sql import functions as F

from wearlens.contract import SEED
from wearlens.functions.search import HASH_PRIME, portable_hash
from wearlens.operators import metrics, splits
from wearlens.plans import models


def frame(spark, labels, scores, groups=None):
    groups = groups or ["g"] * len(labels)
    return spark.createDataFrame(
        [(g, int(y), float(s)) for g, y, s in zip(groups, labels, scores)], "g string, label int, score double"
    )


def brute_ap(y, s):
    total, last, out = y.sum(), 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        hit = s >= t
        recall = y[hit].sum() / total
        out += (recall - last) * y[hit].mean()
        last = recall
    return out


def brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))


@pytest.mark.parametrize("rows_per_slice", [6, 10_000])
def test_ranking_metrics_match_brute_force(spark, rows_per_slice):
    rng = np.random.default_rng(1)
    y, s = rng.integers(0, 2, 300), np.round(rng.random(300), 2)
    row = metrics.ranking_metrics(frame(spark, y, s), rows_per_slice=rows_per_slice).first()
    assert row.pr_auc == pytest.approx(brute_ap(y, s)) and row.roc_auc == pytest.approx(brute_auc(y, s))
    scaled = metrics.ranking_metrics(frame(spark, y, np.exp(3 * s)), rows_per_slice=rows_per_slice).first()
    assert scaled.pr_auc == pytest.approx(row.pr_auc) and scaled.roc_auc == pytest.approx(row.roc_auc)


def test_one_class_gives_a_reason_not_nan(spark):
    df = frame(spark, [1, 1, 0, 0], [0.1, 0.2, 0.3, 0.4], ["a", "a", "b", "b"])
    rows = {r.g: r for r in metrics.ranking_metrics(df, ["g"]).collect()}
    assert rows["a"].pr_auc is None and rows["a"].reason == "no negatives"
    assert rows["b"].roc_auc is None and rows["b"].reason == "no positives"


def test_published_confusion_arithmetic(spark):
    cells = spark.createDataFrame([(1898, 34, 20, 48)], "tn long, fp long, fn long, tp long")
    row = metrics.rates(cells).first()
    assert round(row.recall, 3) == 0.706 and round(row.precision, 3) == 0.585
    assert round(row.fn_rate, 3) == 0.294 and round(row.fp_rate, 3) == 0.018 and row.n_samples == 2000
    assert row.expected_cost_per_1000 == pytest.approx((5 * 20 + 34) / 2000 * 1000)


def test_scan_matches_direct_counting_and_ties_take_the_lowest(spark):
    rng = np.random.default_rng(2)
    y, s = rng.integers(0, 2, 200), rng.choice([0.05, 0.3, 0.305, 0.5, 0.95, 0.02, 1.0], 200)
    got = metrics.threshold_scan(frame(spark, y, s)).toPandas().sort_values("threshold").reset_index(drop=True)
    assert np.allclose(got.threshold, np.linspace(0.05, 0.95, 181), atol=1e-15)
    for r in got.itertuples():
        hit = s >= r.threshold
        assert (r.tp, r.fp, r.fn, r.tn) == ((hit & (y == 1)).sum(), (hit & (y == 0)).sum(), (~hit & (y == 1)).sum(), (~hit & (y == 0)).sum())
    best = metrics.best_threshold(frame(spark, y, s)).first()
    top = got[got.f2_score == got.f2_score.max()]
    assert best.threshold == top.threshold.min() and best.f2_score == got.f2_score.max()
    assert metrics.SCAN == [float(t) for t in np.linspace(0.05, 0.95, 181)]


def test_undefined_ratios(spark):
    row = metrics.classification_report(frame(spark, [0, 0], [0.1, 0.2]), 0.5).first()
    assert row.precision == row.recall == row.f2_score == 0 and row.fn_rate is None and row.fp_rate == 0


def labelled(spark, n=1000):
    return spark.range(1, n + 1).select(
        F.col("id").alias("unit_id"), (F.pmod(F.xxhash64("id"), F.lit(30)) == 0).cast("int").alias("label")
    )


def test_split_is_exact_stratified_and_column_independent(spark):
    df = labelled(spark)
    split = splits.stratified_split(df).toPandas()
    for _, part in split.groupby("label"):
        n = len(part)
        tests = (2 * n + 5) // 10
        assert (part.split == "test").sum() == tests
        assert (part.split == "validation").sum() == (n - tests + 2) // 4
    wider = splits.stratified_split(df.withColumn("x", F.rand())).toPandas()
    assert dict(zip(split.unit_id, split.split)) == dict(zip(wider.unit_id, wider.split))
    other = splits.stratified_split(df, seed=1).toPandas()
    assert dict(zip(split.unit_id, split.split)) != dict(zip(other.unit_id, other.split))


def test_folds_are_balanced(spark):
    folds = splits.stratified_folds(labelled(spark)).toPandas()
    assert set(folds.fold) == set(range(5))
    for _, part in folds.groupby("label"):
        sizes = part.groupby("fold").size()
        assert sizes.max() - sizes.min() <= 1


def test_sample_is_exact_and_weights_balance(spark):
    df = labelled(spark)
    assert splits.reference_sample(df, 100).count() == 100 and splits.reference_sample(df, 5000).count() == 1000
    weights = splits.class_weights(df).toPandas()
    assert np.allclose(weights.rows * weights.weight, 500)
    audit = splits.split_audit(df.withColumn("split", F.when(F.col("unit_id") < 3, "a").otherwise("b"))).toPandas()
    assert audit.set_index("split").degenerate["a"] and not audit.set_index("split").degenerate["b"]


def classes_apart(spark):
    """The hash that splits go by puts all rows of class 0 before those of class 1."""
    df = spark.range(4000).withColumnRenamed("id", "unit_id")
    return df.withColumn("label", (portable_hash("unit_id", SEED) * 2 > HASH_PRIME).cast("long"))


def test_rows_of_a_fit_have_the_classes_shares_wherever_their_splits_begin(spark, monkeypatch):
    monkeypatch.setattr(models, "FIT_ROWS", 200)
    train = splits.stratified_split(classes_apart(spark)).filter("split = 'train'")
    taken = models.bounded(train).toPandas()
    assert len(taken) == 200 and 0.4 < taken.label.mean() < 0.6


def test_rows_of_a_fit_are_the_smallest_by_hash_and_id(spark):
    df = classes_apart(spark)
    want = splits.reference_sample(df, 300, seed=SEED + 1)
    got = splits.fit_sample(df, 300)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert splits.fit_sample(df.limit(0), 300).isEmpty() and splits.fit_sample(df, 9000).count() == 4000
