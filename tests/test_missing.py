"""Inputs with holes: nothing may vanish without a word."""

from pyspark.sql import functions as F

from wearlens.contract import SENSORS
from wearlens.operators import cleaning, drift, ordered, profiling, rolling, splits, validation
from wearlens.sources import files

NAN = float("nan")


def test_rows_without_a_label_are_split_too(spark):
    df = spark.createDataFrame([(i, None if i % 2 else i % 4 // 2) for i in range(20)], "unit_id long, label int")
    assert splits.stratified_split(df).count() == 20
    assert splits.stratified_folds(df, 2).groupBy("fold").count().count() == 2


def _frames(spark):
    rows = [("M", float(i % 7), float(i), 0.5, i) for i in range(300)]
    ref = spark.createDataFrame(rows, "type string, a double, b double, prediction double, minute int")
    return ref, ref.withColumn("b", F.lit(None).cast("double")).withColumn("prediction", F.lit(NAN))


def test_drift_keeps_columns_without_current_values(spark):
    ref, cur = _frames(spark)
    by = {r.column: r for r in drift.drift_by_column(ref, cur, ["a", "b", "prediction"], ["type"]).collect()}
    assert set(by) == {"a", "b", "prediction", "type"}
    assert by["b"].drifted and by["b"].score is None and by["b"].reason == "no_current_values" and by["prediction"].reason == "no_current_values"
    assert not by["a"].drifted and by["a"].reason is None
    back = {r.column: r.reason for r in drift.drift_by_column(cur, ref, ["a", "b"], ["type"]).collect()}
    assert back["b"] == "no_reference_values"
    row = drift.drift_summary(ref, cur, numeric=["a", "b", "prediction"]).first()
    assert row.total_columns == 4 and row.drifted_column_count == 2 and row.drift_detected


def test_drift_keeps_windows_without_rows(spark):
    ref, _ = _frames(spark)
    stamped = ref.withColumn("ts", F.timestamp_seconds(1_700_000_000 - F.col("minute") * 60 - 3600))
    rows = drift.drift_by_window(ref, stamped, [30, 120], F.timestamp_seconds(F.lit(1_700_000_000)), numeric=["a"]).collect()
    assert {(r.window_minutes, r.status) for r in rows} == {(30, "no_current_rows"), (120, "ok")}


def test_short_keys_are_audited(spark, readings):
    df = readings(*[("M", {"tool_wear_min": float(i)}) for i in range(40)], *[("L", {"tool_wear_min": float(i)}) for i in range(3)])
    got = {r.type: r.mismatches for r in rolling.feature_parity(df).collect()}
    assert got == {"M": 0, "L": 0}


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1, NAN), (2, 1.0), (3, None)], "unit_id long, x double")
    assert {r.column: r.nulls for r in profiling.missingness(df).collect()} == {"unit_id": 0, "x": 2}
    assert files.null_tripwire(df, ["x"]).first().nulls == 2
    row = profiling.numeric_profile(df, ["x"]).first()
    assert (row.rows, row.mean, row.max, row.p50) == (1, 1.0, 1.0, 1.0)
    rule = validation.Rule("x", "in_range", F.col("x").between(0, 2))
    assert {(r.unit_id, r.check) for r in validation.contract_failures(df, [rule], unique=False).collect()} == {(1, "not_null"), (3, "not_null")}
    assert [r.t for r in df.select("unit_id", cleaning.action_tier("x").alias("t")).orderBy("unit_id").collect()] == [None, "urgent_alert", None]


def test_log_lines_need_a_feature_but_not_every_one(spark):
    whole = ", ".join(f'"{c}": 1' for c in SENSORS)
    null = whole.replace(": 1", ": null")
    lines = [f'{{"event": "prediction_made", "features": {f}}}' for f in (f"{{{whole}}}", "{}", "null", f"{{{null}}}", f"{{{whole.split(', ')[0]}}}")]
    lines.append('{"event": "prediction_made"}')
    rows = files.prediction_log(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert sorted(sum(r[c] is not None for c in SENSORS) for r in rows) == [0, 1, len(SENSORS)]


def test_raw_files_with_other_spellings_and_headers(spark, tmp_path):
    from wearlens.contract import RAW_TO_WORKING

    names = list(RAW_TO_WORKING)
    values = {c: "1" for c in names} | {"Torque [Nm]": "<NA>", "Type": "n/a", "Air temperature [K]": "#N/A"}
    (tmp_path / "a.csv").write_text(",".join(names) + "\n" + ",".join(values[c] for c in names) + "\n")
    row = files.to_working_schema(files.load_raw(spark, str(tmp_path / "a.csv"))).first()
    assert row.torque_nm is None and row.type is None and row.air_temperature_k is None and row.unit_id == 1


def test_two_level_search_finds_the_same_slices(spark, monkeypatch):
    df = spark.range(4000).select((F.col("id") % 2).alias("k"), F.xxhash64("id").alias("o"), "id").union(spark.range(5).select(F.lit(7).alias("k"), "id", "id"))
    two = ordered.with_slices(df, ["k"], ["o", "id"], 20.0)
    monkeypatch.setattr(ordered, "ONE_LEVEL", 10**9)
    one = ordered.with_slices(df, ["k"], ["o", "id"], 20.0).select("k", "id", F.col("__slice").alias("one"))
    assert two.join(one, ["k", "id"]).filter(~F.col("__slice").eqNullSafe(F.col("one"))).count() == 0
    assert two.agg(F.countDistinct("k", "__slice")).first()[0] > 150
