from datetime import datetime, timedelta

import pytest

from wearlens.operators import oplog

T0 = datetime(2026, 1, 1)


def series(spark, seconds, name="s"):
    rows = [(name, i, T0 + timedelta(seconds=s), float(i)) for i, s in enumerate(seconds)]
    return spark.createDataFrame(rows, "series string, id long, ts timestamp, value double")


@pytest.mark.parametrize("rows_per_slice", [2, 1000])
def test_gaps_and_staleness(spark, rows_per_slice):
    df = series(spark, [0, 15, 30, 150, 165, 600, 615])
    gaps = oplog.series_gaps(df, ["series"], "id", rows_per_slice=rows_per_slice).orderBy("ts").collect()
    assert [(g.gap_seconds, g.hidden) for g in gaps] == [(120, True), (435, False)]
    filled = oplog.asof_fill(df, ["series"], "id", rows_per_slice=rows_per_slice).orderBy("step_ts").collect()
    steps = {int((r.step_ts - T0).total_seconds()): r.value for r in filled}
    assert steps[45] == 2 and steps[135] == 2 and steps[165] == 4 and steps[465] == 4
    assert 480 not in steps and 585 not in steps and steps[600] == 5 and steps[915] == 6 and len(filled) == len(steps)


def test_alert_states(spark):
    df = series(spark, [0, 60], "high").unionByName(series(spark, [0], "zero")).unionByName(
        series(spark, [0], "old").selectExpr("series", "id", "ts - interval 1 hour as ts", "value")
    )
    states = {r.series: r.state for r in oplog.alert_state(df, ["series"], "2026-01-01 00:01:00").collect()}
    assert states == {"high": "ALERT", "zero": "OK", "old": "NoData"}
    edge = df.selectExpr("series", "id", "ts", "0.3D as value")
    assert {r.state for r in oplog.alert_state(edge, ["series"], "2026-01-01 00:01:00").collect()} == {"ALERT", "NoData"}


def log(spark, durations, status=200, path="/predict"):
    rows = [(i, T0 + timedelta(seconds=i), path, status, float(d)) for i, d in enumerate(durations)]
    return spark.createDataFrame(rows, "request_id long, ts timestamp, path string, status_code int, duration_ms double")


def test_bucket_quantiles_interpolate(spark):
    df = log(spark, [1.0] * 5 + [7.0] * 5)
    got = {r.q: r["quantile"] for r in oplog.histogram_quantiles(df, (0.25, 0.5, 0.75)).collect()}
    assert got == {0.25: 2.5, 0.5: 5.0, 0.75: 7.5}
    far = oplog.histogram_quantiles(log(spark, [99_999.0]), (0.5,)).first()
    assert far["quantile"] == oplog.LATENCY_BOUNDS[-1]


def test_rates(spark):
    df = log(spark, [1.0] * 30).unionByName(log(spark, [1.0] * 10, 503))
    row = oplog.error_rate(df).first()
    assert (row.requests, row.errors, row.error_rate) == (40, 10, 0.25)
    assert oplog.throughput(df).first().per_second == pytest.approx(40 / 60)
    assert {r.status: r.requests for r in oplog.status_mix(df).collect()} == {"2xx": 30, "5xx": 10}
    items = {r["item"]: r["value"] for r in oplog.latency_summary(log(spark, range(1, 101))).collect()}
    assert items["requests"] == 100 and items["p50"] == 50.5 and items["slowest"] == 100
    bins = oplog.latency_histogram(log(spark, range(0, 101))).orderBy("bin").collect()
    assert [b.requests for b in bins] == [1] + [10] * 10


def test_rollout(spark):
    rows = [(i, T0 + timedelta(seconds=i), 200, v) for i, v in enumerate([None] * 3 + ["1.1.0", None] + ["1.1.0"] * 3)]
    probes = spark.createDataFrame(rows, "id long, ts timestamp, status int, api_version string")
    timeline = {r.api_version: r for r in oplog.version_timeline(probes).collect()}
    assert timeline["1.1.0"].overlap_seconds == 1 and timeline[None].probes == 4
    for size in (2, 1000):
        changes = oplog.version_changes(probes, "id", size).orderBy("id").collect()
        assert [(c.id, c.from_version, c.to_version) for c in changes] == [(3, None, "1.1.0"), (4, "1.1.0", None), (5, None, "1.1.0")]


def test_reconcile(spark):
    a, b = (spark.createDataFrame([(x,) for x in xs], "m string") for xs in ("abc", "bcdd"))
    assert {(r.m, r.status) for r in oplog.reconcile(a, b, "m").collect()} == {("a", "missing_in_right"), ("d", "missing_in_left")}
