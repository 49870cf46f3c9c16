import json

import pytest
from pyspark.sql import functions as F

from wearlens.contract import FAILURE_FLAGS, LABEL, RAW_TO_WORKING
from wearlens.operators import cleaning, validation
from wearlens.sources import files

TEN = """1,M14860,M,298.1,308.6,1551,,0,2026-01-01T00:00:00
2,L47181,L,999.9,308.7,1408,46.3,3,2026-01-01T00:05:00
3,L47182,L,298.1,308.5,-500,49.4,5,2026-01-01T00:10:00
4,L47183,L,298.2,308.6,1433,39.5,99999,2026-01-01T00:15:00
5,M14861,X,298.3,308.7,1500,40.1,10,2026-01-01T00:20:00
6,H29424,H,298.1,308.6,1520,41.0,12,not-a-timestamp
7,L47184,L,298.2,308.7,1490,43.2,15,2026-01-01T00:30:00
8,M14862,M,298.3,308.8,1510,44.0,18,2026-01-01T00:35:00
9,L47185,L,298.2,308.6,1505,42.0,20,2026-01-01T00:40:00
10,H29425,H,298.1,308.7,1495,41.5,22,2026-01-01T00:45:00"""
SCHEMA = (
    "unit_id int, product_id string, type string, air_temperature_k double, process_temperature_k double, "
    "rotational_speed_rpm int, torque_nm double, tool_wear_min int, timestamp string"
)


@pytest.fixture(scope="module")
def ten(spark):
    def row(line):
        i, p, t, a, b, r, q, w, s = line.split(",")
        return int(i), p, t, float(a), float(b), int(r), float(q) if q else None, int(w), s

    df = spark.createDataFrame([row(line) for line in TEN.splitlines()], SCHEMA)
    return df.withColumns({c: F.lit(0) for c in [LABEL, *FAILURE_FLAGS]})


def report_of(df):
    return {r["item"]: r["rows"] for r in cleaning.clean_report_items(cleaning.clean_report(df)).collect()}


def test_golden_faulty_rows(ten):
    stamped = cleaning.drop_bad_timestamps(ten)
    assert ten.count() - stamped.count() == 1 and dict(stamped.dtypes)["timestamp"] == "timestamp"
    df = stamped.drop("timestamp")
    report = report_of(df)
    assert report["rows_in"] == 9 and report["dropped_missing"] == 1 and report["null:torque_nm"] == 1
    assert report["dropped_outliers"] == 3 and report["rows_out"] == 5
    assert [report[f"range:{c}"] for c in cleaning.SENSOR_RANGES] == [1, 0, 1, 0, 1]
    kept = cleaning.clean(df)
    assert sorted(r.unit_id for r in kept.collect()) == [5, 7, 8, 9, 10]
    passed, by_check = validation.validate(kept)
    assert not passed and [tuple(r) for r in by_check.collect()] == [("type", "in_set", 1)]


def test_accounting_adds_up(ten):
    r = report_of(ten)
    assert r["rows_in"] == r["rows_out"] + r["dropped_missing"] + r["dropped_bad_timestamp"] + r["dropped_outliers"]
    assert cleaning.clean(ten).count() == r["rows_out"]
    assert cleaning.with_first_fault(ten).filter("first_fault is null").count() == r["rows_out"]


def test_steps_one_by_one_equal_the_single_scan(ten):
    steps = cleaning.drop_outliers(cleaning.drop_bad_timestamps(cleaning.drop_missing(ten)))
    assert sorted(r.unit_id for r in steps.collect()) == sorted(r.unit_id for r in cleaning.clean(ten).collect())


def test_nan_counts_as_missing_and_out_of_range(ten):
    df = ten.withColumn("torque_nm", F.lit(float("nan")))
    assert cleaning.drop_missing(df).count() == 0 and cleaning.clean(df).count() == 0
    assert {r["column"]: r["rows"] for r in cleaning.outlier_counts(df).collect()}["torque_nm"] == 10


def test_null_timestamps_survive_and_only_the_first_name_counts(ten):
    df = ten.withColumn("recorded_at", F.lit("junk")).withColumn(
        "timestamp", F.when(F.col("unit_id") != 7, F.col("timestamp"))
    )
    assert cleaning.drop_bad_timestamps(df).count() == 9


def test_quarantine_names_every_reason(ten):
    reasons = {r.unit_id: r.reasons for r in cleaning.quarantine(ten).collect()}
    assert reasons == {
        1: ["missing:torque_nm"], 2: ["out_of_range:air_temperature_k"], 3: ["out_of_range:rotational_speed_rpm"],
        4: ["out_of_range:tool_wear_min"], 5: ["bad_category:type"], 6: ["bad_timestamp"],
    }


@pytest.mark.parametrize(
    "change, failure",
    [
        ("999.0D", ("torque_nm", "in_range")),
        ("'X'", ("type", "in_set")),
        ("cast(null as double)", ("air_temperature_k", "not_null")),
        ("'Q1'", ("product_id", "matches_pattern")),
        ("2", ("twf", "in_set")),
        ("-1", ("unit_id", "positive")),
        ("cast(null as int)", (LABEL, "not_null")),
    ],
)
def test_contract_failures(ten, change, failure):
    good = cleaning.clean(ten.drop("timestamp")).filter("unit_id = 7")
    assert validation.validate(good)[0]
    found = validation.contract_failures(good.withColumn(failure[0], F.expr(change))).collect()
    assert [(r["column"], r["check"]) for r in found] == [failure]


def test_duplicates_types_and_extra_columns(ten):
    good = cleaning.clean(ten.drop("timestamp")).filter("unit_id > 5").withColumn("extra", F.lit(1))
    assert validation.validate(good)[0]
    twice = good.unionByName(good.filter("unit_id = 7"))
    assert [(r.unit_id, r["check"]) for r in validation.contract_failures(twice).collect()] == [(7, "unique")] * 2
    passed, why = validation.validate(good.withColumn("torque_nm", F.col("torque_nm").cast("string")))
    assert not passed and why.first()["check"] == "type:string"


def test_raw_file_with_byte_order_mark(spark, tmp_path):
    path = tmp_path / "raw.csv"
    header = ",".join(RAW_TO_WORKING)
    path.write_text(f"﻿{header}\n1,M14860,M,298.1,308.6,1551,NA,0,0,0,0,0,0,0\n", encoding="utf-8")
    raw = files.load_raw(spark, str(path))
    row = files.to_working_schema(raw).first()
    assert row.unit_id == 1 and row.torque_nm is None and row.rotational_speed_rpm == 1551
    path.write_text("UDI,Type\n1,M\n")
    with pytest.raises(ValueError, match="Torque"):
        files.load_raw(spark, str(path))
    with pytest.raises(Exception):
        files.load_raw(spark, str(tmp_path / "nothing.csv"))


def test_gated_write_and_tripwire(spark, ten, tmp_path):
    df = cleaning.clean(ten.drop("timestamp"))
    out = str(tmp_path / "clean")
    written, failures = files.write_if_valid(df, out)
    assert not written and failures.count() and not (tmp_path / "clean").exists()
    good = df.filter("type <> 'X'")
    written, failures = files.write_if_valid(good.withColumn("torque_nm", F.col("torque_nm").cast("string")), out)
    assert not written and failures.first().check == "type:string" and not (tmp_path / "clean").exists()
    assert files.write_if_valid(good, out)[0]
    assert files.load_cleaned(spark, out).count() == 5  # row 6 is fine once its bad timestamp column is gone
    good.withColumn("torque_nm", F.lit(None).cast("double")).write.parquet(str(tmp_path / "holes"))
    with pytest.raises(ValueError, match="torque_nm=5"):
        files.load_cleaned(spark, str(tmp_path / "holes"))
    with pytest.raises(ValueError, match="leak"):
        files.training_frame(good, ["torque_nm", "twf"])


def prediction(**change):
    body = {
        "timestamp": "2026-01-01T11:30:00Z", "event": "prediction_made", "machine_type": "L", "failure_probability": 0.5,
        "model_version": "2",
        "features": {c: 1.0 for c in cleaning.SENSOR_RANGES},
    }
    body.update(change)
    return json.dumps({k: v for k, v in body.items() if v is not None})


def test_prediction_log_modes(spark, tmp_path):
    good = prediction()
    lines = [
        good, "   ", "{broken", prediction(event="request_handled"), prediction(model_version="1"),
        prediction(features=None), prediction(timestamp="2026-01-01T01:00:00Z"),
    ]
    path = tmp_path / "log.jsonl"
    path.write_text("\n".join(lines))
    text = spark.read.text(str(path))
    window = files.prediction_log(text, as_of="2026-01-01 12:00:00", window_minutes=60, model_version="2")
    assert [r.prediction for r in window.collect()] == [0.5]
    assert files.prediction_log(text).count() == 3
    strict = spark.createDataFrame([(good,), ("  ",)], "value string")
    assert files.prediction_log(strict, "failfast").count() == 1
    for bad in ("{broken", prediction(features=None)):
        with pytest.raises(Exception):
            files.prediction_log(spark.createDataFrame([(bad,)], "value string"), "failfast").collect()


def test_probe_log(spark):
    lines = ["09:19:31.3N code=200 api_version=None"] * 61 + ["09:20:27.3N code=200 api_version=1.1.0"] * 108
    got = files.probe_log(spark.createDataFrame([(v,) for v in lines], "value string"))
    counts = {r.api_version: r["count"] for r in got.groupBy("api_version").count().collect()}
    assert counts == {None: 61, "1.1.0": 108} and got.filter("status <> 200").isEmpty()
