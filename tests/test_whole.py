import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.test_training import SMALL, synthetic
from wearlens.contract import SENSORS
from wearlens.operators import forest, training, whole
from wearlens.plans import models


@pytest.fixture(scope="module")
def table(spark):
    return training.materialize(training.training_frame(spark.createDataFrame(synthetic(150))), "fixture")


@pytest.fixture
def fitted(monkeypatch):
    """Rows of every fit that is grown: (trees, fold, rows)."""
    seen, grow = [], training.grow_fits
    monkeypatch.setattr(training, "grow_fits", lambda spark, fits, *more: seen.extend((c.trees, f, sum(x[4] for x in r.without(f))) for r, c, f in fits) or grow(spark, fits, *more))
    return seen


@pytest.fixture
def query(spark, table, monkeypatch):
    """A model query over ``table``, with a bound on fits that must not bind."""
    monkeypatch.setattr(models, "cleaned", lambda *_: None)
    monkeypatch.setattr(models.training, "feature_table", lambda *_: table)
    monkeypatch.setattr(models, "FIT_ROWS", 100)
    monkeypatch.setattr(models, "DEFAULT", SMALL)
    return lambda q: q(spark, "").collect()


def test_rf_scores_are_fitted_on_all_training_rows(query, fitted, table):
    rows = query(models.rf_scores)
    train = training.stratified_split(table).filter("split = 'train'").count()
    assert fitted == [(15, forest.ALL, train)] and sum(r.rows for r in rows) == 450 - train
    assert all(r.rows == r.probabilities == r.tiers for r in rows)


def test_cv_pr_auc_is_fitted_on_all_rows_of_the_other_folds(query, fitted):
    rows = [r for r in query(models.cv_pr_auc) if r.fold >= 0]
    assert sorted(f[1] for f in fitted) == list(range(5))
    assert {f: n for _, f, n in fitted} == {r.fold: 450 - r.rows for r in rows}


@pytest.mark.parametrize("name", ["calibrated_scores", "isotonic_scores"])
def test_calibration_takes_all_training_rows(query, fitted, table, monkeypatch, name):
    held, maps = [], training._sigmoids
    monkeypatch.setattr(training, "_sigmoids", lambda scored, counts: held.append(scored.count()) or maps(scored, counts))
    of = training.IsotonicMap.fit.__func__
    monkeypatch.setattr(training.IsotonicMap, "fit", classmethod(lambda cls, df, *more: held.append(df.count()) or of(cls, df, *more)))
    assert len(query(getattr(models, name))) == 2
    train = training.stratified_split(table).filter("split = 'train'").count()
    assert fitted[0] == (15, forest.ALL, train) and sum(n for _, _, n in fitted[1:]) == 4 * train and sum(held) == train


def test_grid_is_fitted_on_all_training_rows_and_shares_equal_trees(spark, fitted, tmp_path):
    df = spark.createDataFrame(synthetic(60))
    few = {"trees": 4, "depth": 3, "rolling": False}
    configs = [
        training.Config("a", **few), training.Config("b", **few, scaler="minmax"), training.Config("c", **few, calibration="isotonic"),
        training.Config("d", **{**few, "trees": 6}), training.Config("e", **{**few, "depth": None}, class_weight="balanced_subsample"),
    ]
    path = str(tmp_path)
    rows = training.run_grid(df, configs, folds=2, models_path=path).orderBy("seq").toPandas()
    assert [f[0] for f in fitted] == [6, 6, 4, 4] and sum(f[2] for f in fitted) == 2 * 107  # both folds of all 107 rows, twice
    assert rows.val_brier_score[0] == rows.val_brier_score[1] and len(set(rows.val_brier_score)) == 4
    frame = training.materialize(training.feature_table(df), "features")
    for seq in (2, 3):
        model, threshold, _ = training.load_model_at(spark, rows.path[seq])
        test = model.score(training.stratified_split(frame).filter("split = 'test'")).toPandas()
        assert ((test.score - test.label) ** 2).mean() == pytest.approx(rows.test_brier_score[seq]) and threshold == rows.threshold[seq]


def test_equal_to_a_fit_on_its_own(spark, table):
    """Runs that share trees score as runs alone do."""
    parted = training._folds(table, 2, 1)
    configs = [training.Config("a", trees=4, depth=4, rolling=False), training.Config("b", trees=9, depth=4, rolling=False)]
    both = training.cross_fitted({0: parted}, [(0, c, SENSORS) for c in configs], 2, 1)
    for config, (model, _) in zip(configs, both):
        ((alone, _),) = training.cross_fitted({0: parted}, [(0, config, SENSORS)], 2, 1)
        a, b = (m.score(table).orderBy("unit_id").toPandas().score for m in (model, alone))
        np.testing.assert_allclose(a, b, atol=1e-6)


@pytest.mark.parametrize("depth, weights", [(3, "balanced"), (None, "balanced_subsample"), (6, None)])
def test_trees_of_rows_in_parts_equal_those_of_rows_in_one_task(spark, table, monkeypatch, depth, weights):
    """With one feature nothing is left to choose, so both ways must make the same cuts."""
    monkeypatch.setattr(whole, "CHUNK", 40)
    rows = whole.Rows.of(table.withColumn("type", F.lit(None).cast("string")), ["torque_nm"])
    assert sum(c[4] for c in rows.chunks) == 450 and len(rows.chunks) > 9
    config = training.Config("c", trees=7, depth=depth, min_leaf=2, class_weight=weights)
    columns = []
    for held in (450, 449, 40):
        path = whole.grow_fits(spark, [(rows, config, forest.ALL)], 1, held)
        columns.append(training.Whole(rows.features, path, "sigmoid", [(0, 7, None)]).score(table.select("unit_id", F.lit(None).cast("string").alias("type"), "torque_nm")).orderBy("unit_id").toPandas().score)
    assert columns[0].nunique() > 5
    for c in columns[1:]:
        np.testing.assert_allclose(c, columns[0], atol=1e-6)


def test_rows_in_parts_learn_all_features(spark, table):
    rows = whole.Rows.of(table, SENSORS)
    config = training.Config("c", trees=60, depth=6, rolling=False)
    scores = []
    for held in (1000, 150):
        model = training.Whole(rows.features, whole.grow_fits(spark, [(rows, config, forest.ALL)], 1, held), "sigmoid", [(0, 60, None)])
        scores.append(model.score(table).orderBy("unit_id").toPandas().score)
    other = training.score(training.fit(table, config), table).orderBy("unit_id").toPandas().score
    assert min(np.corrcoef(s, other)[0, 1] for s in scores) > 0.95 and max(abs(s - other).mean() for s in scores) < 0.08


def test_a_cut_is_the_best_of_all():
    rng = np.random.default_rng(4)
    x = rng.integers(0, 20, (1, 300)).astype(np.uint8)
    y = ((x[0] > 12) ^ (rng.random(300) < 0.1)).astype(np.uint8)
    times = np.bincount(rng.integers(0, 300, 300), minlength=300).astype(np.uint16)
    feature, cut, *_ = whole.grow_tree(x << 1, y, times, training.Config("c", depth=1, min_leaf=3), (0.7, 2.0), rng)

    def impurity(c):
        out = 0.0
        for side in (x[0] <= c, x[0] > c):
            if (times[side] > 0).sum() < 3:
                return np.inf
            a, b = 2.0 * (times * y)[side].sum(), 0.7 * (times * (1 - y))[side].sum()
            out += a * b / (a + b)
        return out

    assert feature[0] == 0 and impurity(cut[0]) == min(impurity(c) for c in range(20))


def test_edges_are_those_of_all_values():
    rng = np.random.default_rng(5)
    few, many = rng.integers(0, 40, 5000) / 4, rng.normal(size=50_000)
    np.testing.assert_array_equal(whole.cuts_between(*np.unique(few, return_counts=True)), forest._edges(few))
    parts = [whole.thinned(*np.unique(p, return_counts=True), 1024) for p in np.array_split(many, 10)]
    edges = whole.cuts_between(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
    assert all(n.sum() == 5000 for _, n in parts) and len(edges) == whole.BINS - 1
    shares = np.searchsorted(np.sort(many), edges) / len(many)
    assert abs(shares - (np.arange(63) + 0.5) / 63)[1:-1].max() < 0.003  # the outer cuts are half way in value, not in rows


def test_platt_maps_of_many_groups_equal_plain_fits(spark):
    rng = np.random.default_rng(6)
    df = pd.DataFrame({"g": rng.choice(["a", "b"], 600), "score": np.round(rng.random(600), 2)})
    df["label"] = (rng.random(600) < df.score ** df.g.map({"a": 1, "b": 4})).astype(int)
    counts = {g: (int((p.label == 0).sum()), int(p.label.sum())) for g, p in df.groupby("g")}
    maps = training._sigmoids(spark.createDataFrame(df), counts)
    for g, p in df.groupby("g"):
        assert maps[g] == pytest.approx(forest.sigmoid(p.score.to_numpy(), p.label.to_numpy()), rel=1e-5)


def test_nulls_raise_and_unknown_types_score(spark, table):
    model = training.fit_whole(table, SMALL)
    with pytest.raises(Exception, match="null feature"):
        model.score(table.withColumn("torque_nm", F.lit(None).cast("double"))).collect()
    assert model.score(table.withColumn("type", F.lit("Z"))).filter("score between 0 and 1").count() == 450
    with pytest.raises(ValueError, match="no rows"):
        training.fit_whole(table.limit(0), SMALL)
