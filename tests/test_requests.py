import json

import pytest

from tests.conftest import BASE
from wearlens.operators.requests import accepted, check_requests, rejection_errors, request_features

LIVE = [(298.1, 308.6, 1551, 42.8, 0), (298.3, 308.8, 1500, 45.1, 12), (298.9, 309.4, 1400, 51.3, 27), (300.1, 310.9, 1280, 58.9, 45)]


def body(readings=None, drop=(), **change):
    request = {"vehicle_id": "veh-1", "type": "M", "telemetry_window": [BASE] if readings is None else readings}
    request.update(change)
    return json.dumps({k: v for k, v in request.items() if k not in drop})


def errors(spark, text):
    df = spark.createDataFrame([(1, text)], "request_id int, body string")
    return [(r.loc, r.error_type, r.msg) for r in rejection_errors(check_requests(df), ["request_id"]).collect()]


def reading(**change):
    return {k: v for k, v in {**BASE, **change}.items() if v != "absent"}


AT = "body.telemetry_window.0."


@pytest.mark.parametrize(
    "text, loc, kind",
    [
        (body([reading(torque_nm=200.0)]), AT + "torque_nm", "less_than_equal"),
        (body([reading(rotational_speed_rpm=-50)]), AT + "rotational_speed_rpm", "greater_than_equal"),
        (body([reading(torque_nm="absent")]), AT + "torque_nm", "missing"),
        (body([reading(air_temperature_k="hot")]), AT + "air_temperature_k", "float_parsing"),
        (body([reading(air_temperature_k=None)]), AT + "air_temperature_k", "float_type"),
        (body([reading(recorded_at="soon")]), AT + "recorded_at", "datetime_parsing"),
        (body(type="Z"), "body.type", "enum"),
        (body([]), "body.telemetry_window", "too_short"),
        (body([BASE] * 501), "body.telemetry_window", "too_long"),
        (body(vehicle_id=""), "body.vehicle_id", "string_too_short"),
        (body(drop=["vehicle_id"]), "body.vehicle_id", "missing"),
        (body(drop=["type"]), "body.type", "missing"),
        (body(drop=["telemetry_window"]), "body.telemetry_window", "missing"),
        (body()[:30], "body", "json_invalid"),
    ],
)
def test_one_fault_one_error(spark, text, loc, kind):
    found = errors(spark, text)
    assert [(e[0], e[1]) for e in found] == [(loc, kind)]


def test_messages_and_limits(spark):
    assert errors(spark, body([reading(torque_nm=200.0)]))[0][2] == "Input should be less than or equal to 150"
    assert errors(spark, body(type="Z"))[0][2] == "Input should be 'L', 'M' or 'H'"
    assert errors(spark, body([reading(torque_nm=150.0, tool_wear_min=400, air_temperature_k=280)] * 500)) == []


def test_all_errors_are_collected(spark):
    text = body([reading(torque_nm=200.0), reading(air_temperature_k="absent", tool_wear_min=-1)], type="Z")
    assert {(e[0], e[1]) for e in errors(spark, text)} == {
        ("body.type", "enum"), (AT + "torque_nm", "less_than_equal"),
        ("body.telemetry_window.1.air_temperature_k", "missing"),
        ("body.telemetry_window.1.tool_wear_min", "greater_than_equal"),
    }


def test_features_of_the_live_window(spark):
    window = [dict(zip(BASE, r)) for r in LIVE]
    df = spark.createDataFrame([(1, body(window)), (2, body(type="Z"))], "request_id int, body string")
    row = request_features(accepted(check_requests(df))).collect()
    assert len(row) == 1 and row[0].readings_used == 4 and row[0].torque_nm == 58.9
    assert row[0].torque_nm_rollmean_w3 == pytest.approx((45.1 + 51.3 + 58.9) / 3)
    assert row[0].torque_nm_rollmean_w5 == pytest.approx((42.8 + 45.1 + 51.3 + 58.9) / 4)
    assert row[0].torque_nm_roc == pytest.approx(7.6)


@pytest.mark.parametrize(
    "change,expected",
    [
        ({"vehicle_id": 123}, {("body.vehicle_id", "string_type")}),
        ({"vehicle_id": {"a": 1}}, {("body.vehicle_id", "string_type")}),
        ({"vehicle_id": None}, {("body.vehicle_id", "string_type")}),
        ({"type": 1}, {("body.type", "enum")}),
        ({"telemetry_window": {}}, {("body.telemetry_window", "list_type")}),
        ({"telemetry_window": [5]}, {("body.telemetry_window.0", "model_type")}),
        ({"telemetry_window": [None]}, {("body.telemetry_window.0", "model_type")}),
    ],
)
def test_json_types_are_respected(spark, change, expected):
    body = {"vehicle_id": "v", "type": "M", "telemetry_window": [{**BASE}], **change}
    rows = spark.createDataFrame([(1, json.dumps(body))], "request_id int, body string")
    checked = check_requests(rows)
    assert {(e.loc, e.type) for e in checked.first().errors} == expected


@pytest.mark.parametrize("stamp,fine", [(1700000000, True), ("2024-01-01T00:00:00Z", True), (None, True), ("soon", False), ({}, False), ([1], False)])
def test_recorded_at_takes_times_and_epochs(spark, stamp, fine):
    body = {"vehicle_id": "v", "type": "M", "telemetry_window": [{**BASE, "torque_nm": "40.5", "recorded_at": stamp}]}
    checked = check_requests(spark.createDataFrame([(1, json.dumps(body))], "request_id int, body string"))
    assert (not checked.first().errors) == fine
    if fine:
        assert accepted(checked).first().telemetry_window[0].torque_nm == 40.5


def test_one_parse_per_request(spark):
    rows = spark.createDataFrame([(1, "{}")], "request_id int, body string")
    plan = request_features(accepted(check_requests(rows)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
