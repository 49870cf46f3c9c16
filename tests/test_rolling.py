import numpy as np
import pytest
from pyspark.sql import functions as F

from wearlens.contract import SENSORS, feature_names
from wearlens.functions.readings import window_features
from wearlens.operators.rolling import (
    boundary_leak, cold_start_skew, feature_parity, rolling_features, stream_prefix,
)

ORDER = ["unit_id"]


def by_id(df):
    return df.toPandas().sort_values("unit_id").reset_index(drop=True)


def test_first_reading(readings):
    row = by_id(rolling_features(readings(("L", {})), ["type"], ORDER)).iloc[0]
    assert row.torque_nm_rollstd_w3 == 0 and row.torque_nm_roc == 0 and row.air_temperature_k_rollmean_w3 == 300


def test_known_sequence(readings):
    df = readings(*[("L", {"torque_nm": t}) for t in (10.0, 20.0, 30.0)])
    row = by_id(rolling_features(df, ["type"], ORDER, windows=(2,))).iloc[2]
    assert row.torque_nm_rollmean_w2 == 25 and row.torque_nm_roc == 10


def test_keys_do_not_mix(readings):
    df = readings(("L", {"torque_nm": 100.0}), ("H", {"torque_nm": 5.0}))
    row = by_id(rolling_features(df, ["type"], ORDER)).iloc[1]
    assert row.torque_nm_rollmean_w3 == 5 and row.torque_nm_roc == 0


def test_missing_sensor_is_named(readings):
    with pytest.raises(ValueError, match="tool_wear_min"):
        rolling_features(readings(("L", {})).drop("tool_wear_min"), ["type"], ORDER)


def test_names():
    assert len(feature_names()) == 25
    assert feature_names(["a"], (2, 3)) == [
        "a_rollmean_w2", "a_rollstd_w2", "a_rollmean_w3", "a_rollstd_w3", "a_roc",
    ]


def test_array_replay_equals_batch(readings):
    rng = np.random.default_rng(0)
    df = readings(*[("M", {c: float(rng.normal(100, 5)) for c in SENSORS}) for _ in range(12)])
    batch = by_id(rolling_features(df, ["type"], ORDER)).iloc[-1]
    arrays = df.groupBy("type").agg(
        F.array_sort(F.collect_list(F.struct("unit_id", F.struct(*SENSORS).alias("r")))).alias("w")
    ).withColumn("w", F.transform("w", lambda x: x["r"]))
    replay = window_features(arrays, "w").toPandas().iloc[0]
    for name in feature_names():
        assert replay[name] == pytest.approx(batch[name], abs=1e-9)


def stream_like(spark, n=4000, keys=3, hot=0.8):
    """One key with most rows, and an order column with few values, so ties are heavy."""
    return (
        spark.range(n)
        .withColumnRenamed("id", "unit_id")
        .withColumn("type", F.when(F.pmod(F.xxhash64("unit_id"), F.lit(100)) < hot * 100, "A").otherwise(
            F.concat(F.lit("k"), (F.col("unit_id") % keys).cast("string"))))
        .withColumn("order", (F.pmod(F.xxhash64("unit_id", F.lit(1)), F.lit(7))).cast("int"))
        .withColumns({c: F.pmod(F.xxhash64("unit_id", F.lit(c)), F.lit(1000)) / 7.0 for c in SENSORS})
    )


@pytest.mark.parametrize("rows_per_slice", [8, 300])
def test_sliced_equals_plain(spark, rows_per_slice):
    df = stream_like(spark)
    plain = by_id(rolling_features(df, ["type"], ["order", "unit_id"]))
    sliced = by_id(rolling_features(df, ["type"], ["order", "unit_id"], rows_per_slice=rows_per_slice))
    assert len(sliced) == len(plain) == 4000
    assert (sliced[plain.columns] == plain).all().all()


def test_sliced_equals_brute_force(spark):
    df = stream_like(spark, 500)
    got = by_id(rolling_features(df, ["type"], ["order", "unit_id"], ["torque_nm"], (3, 5), rows_per_slice=8))
    rows = df.toPandas().sort_values(["type", "order", "unit_id"])
    grouped = rows.groupby("type")["torque_nm"]
    want = rows.assign(
        m=grouped.transform(lambda s: s.rolling(5, min_periods=1).mean()),
        s=grouped.transform(lambda s: s.rolling(5, min_periods=1).std()).fillna(0.0),
        d=grouped.diff().fillna(0.0),
    ).sort_values("unit_id")
    assert np.allclose(got.torque_nm_rollmean_w5, want.m) and np.allclose(got.torque_nm_roc, want.d)
    assert np.allclose(got.torque_nm_rollstd_w5, want.s, atol=1e-6)


def test_no_task_holds_a_hot_key(spark):
    from wearlens.operators.ordered import with_halo

    df = stream_like(spark)
    sizes = with_halo(df, ["type"], ["order", "unit_id"], 4, SENSORS, 100).groupBy("type", "__slice").count()
    assert sizes.agg(F.max("count")).first()[0] < 700  # the hot key alone has about 3,200 rows


def test_audits(spark):
    df = stream_like(spark)
    order = ["order", "unit_id"]
    parity = feature_parity(df, 37, order=order).toPandas()
    assert len(parity) == 4 and (parity.mismatches == 0).all()
    skew = cold_start_skew(df, 4, order=order).toPandas().set_index(["type", "position"])
    assert (skew.xs(1, level=1).diverged == 0).all() and (skew.xs(4, level=1).diverged == 25).all()
    assert stream_prefix(df, 3, order=order).count() == 12
    plain = boundary_leak(df, order=order).toPandas().sort_values("unit_id").reset_index(drop=True)
    sliced = boundary_leak(df, order=order, rows_per_slice=5).toPandas().sort_values("unit_id").reset_index(drop=True)
    assert len(plain) == 16 and np.allclose(plain.unkeyed_mean, sliced.unkeyed_mean)
    assert (plain[plain.type == "A"].leak == 0).all() and (plain.leak != 0).any()
