import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.test_rolling import by_id
from tests.test_streaming import feed, stream_like
from wearlens.contract import SENSORS, feature_names
from wearlens.operators.oplog import reconcile
from wearlens.operators.rolling import rolling_features
from wearlens.plans import streams
from wearlens.streaming.reorder import ReorderBuffer, live_reconcile
from wearlens.streaming.rolling import RollingSink, keyed_rolling
from wearlens.streaming.run import ROCKSDB, start, write_batch


def timed(spark, n):
    return spark.range(n).select(
        F.col("id").alias("unit_id"), F.element_at(F.array(*map(F.lit, "LMH")), (F.col("id") % 3 + 1).cast("int")).alias("type"),
        F.timestamp_seconds(F.lit(1_767_225_600) + F.expr("id div 2") * 10).alias("ts"),
        *[F.pmod(F.xxhash64("id", F.lit(c)), F.lit(1000)).cast("double").alias(c) for c in SENSORS],
    )


def arrivals(spark, df, parts, jitter):
    """Rows by time of arrival: up to ``jitter`` seconds after their event, in ``parts`` equal spans."""
    rows = df.collect()
    rng = random.Random(3)
    when = sorted(((r.ts.timestamp() + rng.uniform(0, jitter), r.unit_id) for r in rows))
    span = len(when) // parts + 1
    return [df.filter(F.col("unit_id").isin([i for _, i in when[k: k + span]])) for k in range(0, len(when), span)]


def test_rows_shuffled_within_the_lateness_give_the_batch_features(spark, tmp_path):
    df = timed(spark, 600)
    sink = RollingSink(str(tmp_path / "out"), order=["ts", "unit_id"])
    buffer = ReorderBuffer(str(tmp_path / "buffer"), sink, 300)
    parts = arrivals(spark, df, 5, 300)
    feed(spark, tmp_path, parts, buffer)
    assert 0 < spark.read.parquet(buffer._slot(4, "waiting")).count() < 600
    buffer.close(spark, 4)
    assert spark.read.parquet(buffer.late).isEmpty() and sink.read(spark, "late").isEmpty()
    want, got = by_id(rolling_features(df, order=["ts", "unit_id"])), by_id(sink.read(spark))
    assert len(got) == 600 and (got[feature_names()] == want[feature_names()]).all().all()


def test_only_rows_behind_the_mark_are_late_and_a_rerun_changes_nothing(spark, tmp_path):
    df = timed(spark, 60)  # 10 seconds per two rows, 290 in all
    out = str(tmp_path / "out")
    buffer = ReorderBuffer(str(tmp_path / "buffer"), lambda b, i: write_batch(b, out, i), 100)
    held_back = "unit_id in (30, 36, 45)"  # events at 150, 180 and 220 seconds; the mark stands at 190
    first, second = df.filter(f"not {held_back}"), df.filter(held_back).unionByName(df.limit(1).withColumn("ts", F.lit(None).cast("timestamp")))
    for batch, i in ((first, 0), (second, 1), (second, 1)):
        buffer(batch, i)
    assert sorted(r.unit_id for r in spark.read.parquet(buffer.late).collect()) == [0, 30, 36]
    buffer.close(spark, 1)
    told = [r.unit_id for r in spark.read.parquet(out).collect()]
    assert sorted(told) == [i for i in range(60) if i not in (30, 36)]
    batches = {r.batch: (r.lo, r.hi) for r in spark.read.parquet(out).groupBy("batch").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).collect()}
    ends = [batches[b] for b in sorted(batches)]
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))


def test_an_empty_first_batch_keeps_the_buffer_empty(spark, tmp_path):
    out = str(tmp_path / "out")
    buffer = ReorderBuffer(str(tmp_path / "buffer"), lambda b, i: write_batch(b, out, i), 100)
    df = timed(spark, 10)
    buffer(df.limit(0), 0)
    buffer(df, 1)
    buffer.close(spark, 1)
    assert spark.read.parquet(out).count() == 10


def test_features_keep_the_columns_asked_for(spark, tmp_path):
    df = timed(spark, 60)
    sink = RollingSink(str(tmp_path / "out"), order=["ts", "unit_id"], columns=["unit_id"])
    feed(spark, tmp_path, [df.filter("unit_id < 30"), df.filter("unit_id >= 30")], sink)
    got, want = by_id(sink.read(spark)), by_id(rolling_features(df, order=["ts", "unit_id"]))
    assert sorted(got.columns) == sorted(["unit_id", *feature_names()])
    assert (got == want[got.columns]).all().all()


def test_arrivals_of_one_file_are_dealt_to_many_tasks(spark, monkeypatch):
    class Seen(Exception):
        pass

    def look(parts, process, purpose):
        parts = [p.groupBy(F.spark_partition_id().alias("task")).count().collect() for p in parts]
        raise Seen([[r["count"] for r in p] for p in parts])

    monkeypatch.setattr(streams, "in_stages", look)
    with pytest.raises(Seen) as seen:
        streams.stream_reordered_features(spark, "/root/testdata/sf0.1")  # one file, by time
    for rows in seen.value.args[0]:
        assert len(rows) > 1 and max(rows) < 2 * sum(rows) / len(rows)


def test_live_reconcile_equals_batch_and_forgets(spark, tmp_path):
    df = spark.range(2000).select(F.concat(F.lit("m"), F.col("id")).alias("marker"), F.timestamp_seconds(F.lit(1_767_225_600) + F.col("id") * 5).alias("ts"), "id")
    left, right = df.filter("id % 17 <> 0").drop("id"), df.filter("id % 13 <> 0").withColumn("ts", F.col("ts") + F.expr("INTERVAL 30 seconds")).drop("id")
    left = left.unionByName(left.filter("marker like '%7'"))  # some lines come twice
    end = spark.range(1).select(F.lit(None).cast("string").alias("marker"), F.timestamp_seconds(F.lit(1_767_225_600 + 100_000)).alias("ts"))
    a, b, out, cp = (str(tmp_path / n) for n in ("a", "b", "out", "cp"))
    middle = F.timestamp_seconds(F.lit(1_767_225_600 + 5000))
    for p, q in ((left.filter(F.col("ts") < middle), right.filter(F.col("ts") < middle)), (left.filter(F.col("ts") >= middle), right.filter(F.col("ts") >= middle)), (end, end)):
        p.write.mode("append").parquet(a), q.write.mode("append").parquet(b)
        streams = [spark.readStream.schema(left.schema).parquet(x) for x in (a, b)]
        query = start(live_reconcile(*streams, "marker", "1 minute", "1 minute"), lambda d, i: write_batch(d, out, i), cp)
        query.awaitTermination()
    got = sorted((r.marker, r.status) for r in spark.read.parquet(out).collect())
    assert got == sorted(map(tuple, reconcile(left, right, "marker").collect()))
    assert sum(s.numRowsTotal for s in query.recentProgress[-1].stateOperators) < 100


def test_idle_keys_start_anew_and_long_batches_are_cut(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    df = stream_like(spark, 300).withColumn("order", F.col("order").cast("long"))
    source, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for rows, part in ((df.filter("order < 3").count(), df.filter("order < 3")), (300, df.filter("order >= 3"))):
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(part.schema).parquet(source)
        features = keyed_rolling(stream, "type", ["order", "unit_id"], idle_ms=1)
        query = start(features, lambda b, i: write_batch(b, out, i), cp, every="1 second")
        for _ in range(30):
            if query.awaitTermination(1) or sum(p["numInputRows"] for p in query.recentProgress):
                break
        query.stop()
    got, whole = by_id(spark.read.parquet(out)), by_id(rolling_features(df.filter("order >= 3"), order=["order", "unit_id"]))
    again = got[got.unit_id.isin(whole.unit_id)].reset_index(drop=True)  # the second part started anew
    assert len(got) == 300 and (again[feature_names()] - whole[feature_names()]).abs().max().max() < 1e-6


def test_features_do_not_depend_on_where_a_long_batch_is_cut(monkeypatch):
    from wearlens.streaming import rolling

    class State:
        rows = []
        get, put = (lambda self: iter(self.rows)), (lambda self, rows: setattr(self, "rows", rows))

    def run(rows_at_once):
        monkeypatch.setattr(rolling, "ROWS_AT_ONCE", rows_at_once)
        rng = np.random.default_rng(1)
        p = rolling.RollingProcessor(["at"], SENSORS, (3, 5), ["at"])
        p.past = State()
        frames = [pd.DataFrame({"at": rng.permutation(np.arange(lo, lo + 50)), **{c: rng.random(50) for c in SENSORS}}) for lo in (0, 50)]
        return pd.concat([o for f in frames for o in p.handleInputRows(("k",), iter([f]), None)], ignore_index=True)

    pd.testing.assert_frame_equal(run(7), run(1000))
