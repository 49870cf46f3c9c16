import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wearlens.contract import SENSORS
from wearlens.operators import audits, training
from wearlens.operators.cleaning import action_tier
from wearlens.plans import models
from wearlens.sources import committed

SMALL = training.Config("small", trees=15, depth=5, rolling=False)


def synthetic(per_type, seed=42):
    rng = np.random.default_rng(seed)
    parts = []
    for kind in ("L", "M", "H"):
        wear, torque = np.sort(rng.uniform(0, 250, per_type)), rng.uniform(15, 65, per_type)
        air = rng.normal(300, 2, per_type)
        label = ((torque > 50) & (wear > 150)) ^ (rng.random(per_type) < 0.03)
        parts.append(
            pd.DataFrame(
                {
                    "type": kind, "air_temperature_k": air, "process_temperature_k": air + rng.normal(10, 1, per_type),
                    "rotational_speed_rpm": rng.normal(1500, 150, per_type), "torque_nm": torque, "tool_wear_min": wear,
                    "machine_failure": label.astype(int),
                }
            )
        )
    out = pd.concat(parts, ignore_index=True)
    return out.assign(unit_id=range(1, len(out) + 1))


@pytest.fixture(scope="module")
def table(spark):
    df = spark.createDataFrame(synthetic(150))
    return training.materialize(training.training_frame(df), "fixture")


@pytest.fixture(scope="module")
def model(table):
    return training.fit_calibrated(table, SMALL, folds=3)


def one(spark, *readings):
    rows = [(i, t, *map(float, r)) for i, (t, *r) in enumerate(readings)]
    return spark.createDataFrame(rows, "unit_id int, type string, " + ", ".join(f"{c} double" for c in SENSORS))


def test_scores_are_probabilities_and_rank(table, model):
    scored = model.score(table)
    low, high = scored.agg(F.min("score"), F.max("score")).first()
    assert 0 <= low < high <= 1 and scored.count() == 450
    assert training.ranking_metrics(scored).first().pr_auc > 0.7


def test_direction_of_risk(spark, model):
    df = one(spark, ("M", 300, 310, 1500, 25, 20), ("M", 300, 310, 1500, 60, 220), ("L", 298, 308, 1500, 20, 5))
    base, escalated, healthy = [r.score for r in model.score(df).orderBy("unit_id").collect()]
    assert escalated > base and healthy < 0.3


def test_unknown_type_scores_without_error(spark, model):
    assert model.score(one(spark, ("Z", 300, 310, 1500, 25, 20))).count() == 1


def test_cross_validation_and_calibration(table):
    folds = training.cross_validated(table, SMALL, folds=3)
    assert folds.count() == 3 and training.cv_summary(folds).first()["mean"] > 0.5
    for kind in ("sigmoid", "isotonic"):
        config = training.Config("c", trees=10, depth=4, rolling=False, calibration=kind)
        effect = {r.kind: r.brier_score for r in training.calibration_effect(table, config, folds=3).collect()}
        assert set(effect) == {"calibrated", "uncalibrated"} and effect["calibrated"] < 0.15


def test_bounded_fits_score_all_rows_held_out(table, monkeypatch):
    fitted, grow = [], training.grow_forests
    monkeypatch.setattr(training, "grow_forests", lambda spark, runs, *more: fitted.extend(len(s.y) for _, s, _ in runs) or grow(spark, runs, *more))
    folds = training.cross_validated(table, SMALL, folds=3, fit_rows=100).collect()
    assert sum(r.rows for r in folds) == 450 and min(r.rows for r in folds) > 140 and fitted == [100] * 3
    effect = training.calibration_effect(table, SMALL, folds=2, fit_rows=100).collect()
    assert {r.kind: r.rows for r in effect} == {"calibrated": 90, "uncalibrated": 90} and max(fitted) == 100


def test_model_queries_hold_out_from_the_whole_table(spark, table, monkeypatch):
    seen = []
    monkeypatch.setattr(models, "cleaned", lambda *_: None)
    monkeypatch.setattr(models.training, "feature_table", lambda _: table)
    monkeypatch.setattr(models, "FIT_ROWS", 120)
    monkeypatch.setattr(models, "DEFAULT", SMALL)
    for name in ("cross_validated", "calibration_effect"):
        call = getattr(training, name)
        monkeypatch.setattr(training, name, lambda df, *more, call=call, **named: seen.append(df.count()) or call(df, *more, **named))
    assert models.cv_pr_auc(spark, "").count() == 6
    assert models.calibrated_scores(spark, "").count() == 2
    assert seen == [450, 450]


def test_one_class_fold_is_refused(table):
    few = table.filter("label = 0").unionByName(table.filter("label = 1").limit(2))
    with pytest.raises(ValueError, match="one class"):
        training.fit_calibrated(few, SMALL, folds=5)


@pytest.mark.parametrize("kind", ["sigmoid", "isotonic"])
def test_save_and_load_by_alias(spark, table, tmp_path, kind):
    config = training.Config("c", trees=3, depth=3, rolling=False, calibration=kind)
    model = training.fit_calibrated(table, config, folds=2)
    path = str(tmp_path / "model")
    training.save_model(spark, model, 0.27, path, "4")
    aliases = spark.createDataFrame([("production", 3, 1), ("production", 4, 2)], "alias string, version int, seq int")
    versions = spark.createDataFrame([(4, path)], "version int, path string")
    loaded, threshold, version = training.load_model(spark, aliases, versions)
    assert (threshold, version) == (0.27, "4")
    same = model.score(table).join(loaded.score(table).withColumnRenamed("score", "again"), "unit_id")
    assert same.filter(F.abs(F.col("score") - F.col("again")) > 1e-12).isEmpty()
    with pytest.raises(LookupError, match="staging"):
        training.load_model(spark, aliases, versions, "staging")


def test_grid_rows(spark, tmp_path):
    df = spark.createDataFrame(synthetic(60))
    configs = [
        training.Config("plain", trees=2, depth=3, rolling=False),
        training.Config("iso", trees=2, depth=3, calibration="isotonic", scaler="minmax", class_weight=None),
    ]
    path = str(tmp_path / "runs")
    rows = training.run_grid(df, configs, "b1", folds=2, runs_path=path).toPandas()
    assert list(rows.sort_values("seq").name) == ["plain", "iso"] and rows.val_expected_cost_per_1000.notna().all()
    assert (rows.test_tn + rows.test_fp + rows.test_fn + rows.test_tp == 36).all()
    assert committed.read(spark, path).count() == 2
    assert len(training.GRID) == 12 and len({c.name for c in training.GRID}) == 12


def test_audits(spark):
    df = spark.createDataFrame(
        [(1, 1, 0, "L", 1.0), (1, 0, 1, "X", 1.0), (0, 0, 0, "M", None), (0, 0, 0, "H", 1.0)],
        "machine_failure int, a int, b int, type string, torque_nm double",
    )
    rows = {r["column"]: r for r in audits.leak_audit(df, ["a", "b"]).collect()}
    assert rows["any_flag"].agreement == 1 and rows["any_flag"].roc_auc == 1 and rows["a"].agreement == 0.75
    bad = audits.bad_input_audit(df, ["torque_nm"]).first()
    assert (bad.rows, bad.unseen_category, bad.missing_sensor, bad.bad_share) == (4, 1, 1, 0.5)


def test_action_tiers(spark):
    df = spark.createDataFrame([(0.26,), (0.27,), (0.59,), (0.6,)], "p double").select(action_tier("p").alias("a"))
    assert [r.a for r in df.collect()] == ["monitor", "schedule_service", "schedule_service", "urgent_alert"]
