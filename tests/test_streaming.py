import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import BASE
from tests.test_requests import body
from tests.test_rolling import by_id, stream_like
from wearlens.contract import SENSORS, feature_names
from wearlens.operators import oplog
from wearlens.operators.drift import drift_summary
from wearlens.operators.rolling import rolling_features
from wearlens.streaming.requests import RequestSink
from wearlens.streaming.rolling import RollingSink, keyed_rolling
from wearlens.streaming.run import ROCKSDB, start, write_batch
from wearlens.streaming.windows import DriftSink, current_values, live

ORDER = ["order", "unit_id"]


def feed(spark, tmp_path, parts, process, name="s", transform=lambda s: s):
    """Each part is one run of the same stream: a restart from its checkpoint."""
    source = str(tmp_path / f"{name}-in")
    for part in parts:
        part.write.mode("append").parquet(source)
        stream = transform(spark.readStream.schema(part.schema).parquet(source))
        start(stream, process, str(tmp_path / f"{name}-cp")).awaitTermination()


@pytest.mark.parametrize("rows_per_slice", [100, 1_000_000])
def test_restarted_stream_equals_batch(spark, tmp_path, rows_per_slice):
    df = stream_like(spark, 1500)
    sink = RollingSink(str(tmp_path / "out"), order=ORDER, rows_per_slice=rows_per_slice)
    feed(spark, tmp_path, [df.filter("order < 2"), df.filter("order between 2 and 4"), df.filter("order > 4")], sink)
    batch, stream = by_id(rolling_features(df, order=ORDER)), by_id(sink.read(spark))
    assert (stream[batch.columns] == batch).all().all() and sink.read(spark, "late").isEmpty()


def test_rerun_of_a_batch_replaces_its_output(spark, tmp_path):
    df = stream_like(spark, 300)
    sink = RollingSink(str(tmp_path / "out"), order=ORDER)
    sink(df.filter("order < 3"), 0)
    sink(df.filter("order >= 3"), 1)
    sink(df.filter("order >= 3"), 1)
    assert (by_id(sink.read(spark))[feature_names()] == by_id(rolling_features(df, order=ORDER))[feature_names()]).all().all()


def test_seeded_start_equals_batch_and_unseeded_does_not(spark, tmp_path):
    df = stream_like(spark, 600)
    old, new = df.filter("order < 3"), df.filter("order >= 3")
    want = by_id(rolling_features(df, order=ORDER).filter("order >= 3"))
    seeded, cold = (RollingSink(str(tmp_path / n), order=ORDER, history=h) for n, h in (("seeded", old), ("cold", None)))
    for n, sink in (("a", seeded), ("b", cold)):
        feed(spark, tmp_path, [new], sink, n)
    assert (by_id(seeded.read(spark))[feature_names()] == want[feature_names()]).all().all()
    assert not (by_id(cold.read(spark))[feature_names()] == want[feature_names()]).all().all()


def test_late_rows_go_to_the_side_table(spark, tmp_path, readings):
    df = readings(*[("L", {"torque_nm": float(i)}) for i in range(6)])
    sink = RollingSink(str(tmp_path / "out"), order=["unit_id"])
    feed(spark, tmp_path, [df.filter("unit_id <> 2 and unit_id < 5"), df.filter("unit_id in (2, 5)")], sink)
    assert [r.unit_id for r in sink.read(spark, "late").collect()] == [2]
    assert by_id(sink.read(spark)).unit_id.tolist() == [0, 1, 3, 4, 5]


def test_keyed_state_equals_batch_across_restart(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    df = stream_like(spark, 400, hot=0.2).withColumn("order", F.col("order").cast("long"))
    out = str(tmp_path / "out")
    feed(
        spark, tmp_path, [df.filter("order < 3"), df.filter("order >= 3"), df.filter("unit_id = 1")],
        lambda b, i: write_batch(b, out, i), transform=lambda s: keyed_rolling(s, "type", ORDER),
    )
    got = spark.read.parquet(out)
    assert got.filter("late").count() == 1
    batch, stream = by_id(rolling_features(df, order=ORDER)), by_id(got.filter("not late"))
    assert len(stream) == 400
    assert (stream[feature_names()] - batch[feature_names()]).abs().max().max() < 1e-6


def test_requests_split_into_two_sinks(spark, tmp_path):
    rows = [(1, body(), "2026-01-01 00:00:00"), (2, body(type="Z"), "2026-01-01 00:00:00"), (3, "{", "2026-01-01 00:00:01")]
    df = spark.createDataFrame(rows, "request_id int, body string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    sink = RequestSink(str(tmp_path / "out"), lambda f: f.withColumn("score", F.lit(0.7)), "9")
    feed(spark, tmp_path, [df], sink)
    row = spark.read.parquet(sink.accepted).first()
    assert (row.request_id, row.recommended_action, row.model_version, row.readings_used) == (1, "urgent_alert", "9", 1)
    assert sorted(r.request_id for r in spark.read.parquet(sink.rejected).collect()) == [2, 3]
    lines = [json.loads(r.value) for r in spark.read.text(sink.log).collect()]
    assert sorted(line["event"] for line in lines) == ["prediction_made", "validation_rejected", "validation_rejected"]
    assert all(BASE.keys() & line.keys() == set() for line in lines if line["event"] == "validation_rejected")


def test_live_metrics_equal_batch(spark, tmp_path):
    df = spark.range(500).select(
        F.timestamp_seconds(F.lit(1_767_225_600) + F.col("id") * 7).alias("ts"),
        F.when(F.col("id") % 9 == 0, 500).otherwise(200).alias("status_code"),
        F.lit("/predict").alias("path"),
    )
    source, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for part in (df.filter("unix_timestamp(ts) % 2 = 0"), df.filter("unix_timestamp(ts) % 2 = 1")):
        part.write.mode("append").parquet(source)
        log = spark.readStream.schema(df.schema).parquet(source)
        live(log, oplog.status_mix, out, cp, lateness="2 hours").awaitTermination()
    got = current_values(spark, out, ["window_start", "status"]).toPandas().sort_values(["window_start", "status"])
    want = oplog.status_mix(df).toPandas().sort_values(["window_start", "status"])
    pd.testing.assert_frame_equal(got.reset_index(drop=True), want.reset_index(drop=True), check_dtype=False)


def test_trailing_drift_forgets_old_rows(spark, tmp_path):
    def part(day, shift):
        return spark.range(200).select(
            *[(F.pmod(F.xxhash64("id", F.lit(c)), F.lit(1000)) / 10.0 + shift).alias(c) for c in SENSORS],
            F.lit("L").alias("type"), (F.col("id") / 200).alias("prediction"),
            F.timestamp_seconds(F.lit(1_767_225_600 + day * 86_400) + F.col("id")).alias("ts"),
        )

    sink = DriftSink(str(tmp_path / "out"), part(0, 0.0), 1)
    feed(spark, tmp_path, [part(1, 0.0), part(5, 500.0), part(9, 0.0)], sink)
    rows = spark.read.parquet(sink.summaries).orderBy("as_of").collect()
    assert [r.drift_detected for r in rows] == [False, True, False]
    assert all(r.current_window_size == 200 for r in rows)


def test_trailing_drift_adds_days_and_reads_no_more_with_more_batches(spark, tmp_path):
    def part(day, k):
        return spark.range(40).select(
            *[((F.col("id") + k) % 50).cast("double").alias(c) for c in SENSORS], F.lit("LMH"[k % 3]).alias("type"), (F.col("id") / 40).alias("prediction"),
            F.timestamp_seconds(F.lit(1_767_225_600 + day * 86_400 + k) + F.col("id")).alias("ts"),
        )

    sink = DriftSink(str(tmp_path / "out"), part(0, 0), 2)
    parts = [part(1 + k // 5, k) for k in range(15)]
    read = []
    for k, p in enumerate(parts):
        sink(p, k)
        if k == 7:
            sink(p, k)  # again, as after a lost driver
        read.append(sink.counts(spark, {d: max(b) for d, b in sink.versions(spark).items() if d >= "2026-01-03"}).count())
    rows = spark.read.parquet(sink.summaries).orderBy("batch").collect()
    for k in (4, 7, 14):
        window = [p for d, p in ((1 + j // 5, parts[j]) for j in range(k + 1)) if 1 + k // 5 - 2 < d]
        whole = window[0]
        for p in window[1:]:
            whole = whole.unionByName(p)
        want = drift_summary(part(0, 0), whole).first()
        assert (rows[k].current_window_size, round(rows[k].drift_score, 9)) == (want.current_window_size, round(want.drift_score, 9))
        assert {c: round(v, 9) for c, v in rows[k].per_column_drift.items()} == {c: round(v, 9) for c, v in want.per_column_drift.items()}
    assert read[-1] <= 2 * (6 * 50 + 3) and all(len(b) <= 2 for b in sink.versions(spark).values())


def test_processor_loads_where_the_package_is_not_installed(spark, tmp_path):
    import subprocess
    import sys

    from pyspark import cloudpickle

    from wearlens.streaming.rolling import RollingProcessor

    keyed_rolling(stream_like(spark, 10), "type", ORDER)  # registers the package
    path = tmp_path / "processor.pickle"
    path.write_bytes(cloudpickle.dumps(RollingProcessor(ORDER, SENSORS, (3, 5), ["type", *ORDER])))
    code = f"import pickle, sys; p = pickle.load(open({str(path)!r}, 'rb')); assert 'wearlens' not in sys.modules; print(p.windows)"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=60)
    assert out.stdout.strip() == "(3, 5)", out.stderr


def test_one_call_serves_many_keys():
    """Keys of one part in one call, over two calls and with late rows: every key as if it were alone."""
    import numpy as np

    from wearlens.streaming.rolling import RollingProcessor

    class State:
        rows = []
        get, put = (lambda self: iter(self.rows)), (lambda self, rows: setattr(self, "rows", rows))

    rng = np.random.default_rng(4)
    df = pd.DataFrame({"v": rng.integers(0, 30, 400), "at": np.arange(400) // 3, "id": 2**60 + np.arange(400), **{c: rng.random(400) for c in SENSORS}})
    behind = df[(df["at"] < 60) & (df["v"] == 7)].tail(1)
    parts = [df[df["at"] < 60].sample(frac=1, random_state=1), pd.concat([df[df["at"] >= 60], behind])]

    def run(frames):
        p = RollingProcessor(["at", "id"], SENSORS, (3, 5), ["v", "at", "id"])
        p.past = State()
        out = [o for f in frames for o in p.handleInputRows((0,), iter([f]), None)]
        return pd.concat([o for o in out if len(o)], ignore_index=True)

    got = run(parts)
    assert got[got.late].id.tolist() == behind.id.tolist()
    want = df.sort_values(["v", "at", "id"])
    for c in SENSORS:
        of = want.groupby("v")[c]
        for w in (3, 5):
            want[f"{c}_rollmean_w{w}"] = of.transform(lambda x: x.rolling(w, min_periods=1).mean())
            want[f"{c}_rollstd_w{w}"] = of.transform(lambda x: x.rolling(w, min_periods=1).std().fillna(0.0))
        want[f"{c}_roc"] = of.diff().fillna(0.0)
    fresh, want = (x.sort_values("id").reset_index(drop=True) for x in (got[~got.late.astype(bool)], want))
    assert fresh[["v", "at", "id"]].equals(want[["v", "at", "id"]])
    assert (fresh[feature_names()] - want[feature_names()]).abs().max().max() < 1e-6


def test_scores_are_dealt_to_all_cores_and_made_once(spark, tmp_path):
    """A few slices come out of the windows, yet scoring has more tasks than cores; no row of requests is scored twice."""
    seen = spark.sparkContext.accumulator(0)

    def score(df):
        def run(batches):
            for b in batches:
                seen.add(b.num_rows)
                yield b

        return df.mapInArrow(run, df.schema).withColumns({"score": F.lit(0.5), "task": F.spark_partition_id()})

    sink = RollingSink(str(tmp_path / "rolling"), order=ORDER, score=score)
    sink(stream_like(spark, 3000), 0)
    assert sink.read(spark).select("task").distinct().count() > spark.sparkContext.defaultParallelism
    assert seen.value == sink.read(spark).count()
    seen.value = 0
    rows = [(i, body(), "2026-01-01 00:00:00") for i in range(20)]
    df = spark.createDataFrame(rows, "request_id int, body string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    RequestSink(str(tmp_path / "requests"), score)(df, 0)
    assert seen.value == 20
