"""Streaming queries: the given tables are fed through a stream, and its sink is returned."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wearlens.contract import SENSORS, feature_names
from wearlens.operators import oplog, training
from wearlens.operators.requests import rejection_errors
from wearlens.operators.training import materialize
from wearlens.plans.models import bounded_forest
from wearlens.plans.queries import cleaned, drift_frames, flat_summary
from wearlens.session import new_folder
from wearlens.sources import files, tables
from wearlens.streaming.reorder import ReorderBuffer, live_reconcile
from wearlens.streaming.requests import RequestSink
from wearlens.streaming.rolling import RollingSink, keyed_rolling
from wearlens.streaming.run import ROCKSDB, start, write_batch
from wearlens.streaming.windows import DriftSink, current_values, live


def event_stream(spark: SparkSession, d: str) -> DataFrame:
    """``events`` as a stream. The pattern lets the table be one file as well as a folder of files."""
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    return tables.from_events(spark.readStream.schema(schema).parquet(f"{d}/events.parque[t]"))


def in_stages(parts: list[DataFrame], process, purpose: str) -> None:
    """Feed ``parts`` one after the other through the same stream, restarting it each time."""
    spark = parts[0].sparkSession
    source, checkpoint = new_folder(spark, purpose), new_folder(spark, f"{purpose}-checkpoint")
    for part in parts:
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(part.schema).parquet(source)
        start(stream, process, checkpoint).awaitTermination()


def stream_rolling_features(spark, d):
    """The lower half of the wear range arrives first, the upper half after a restart."""
    rows = cleaned(spark, d)
    sink = RollingSink(new_folder(spark, "rolling"))
    in_stages([rows.filter("tool_wear_min < 127"), rows.filter("tool_wear_min >= 127")], sink, "readings")
    return sink.read(spark).select("unit_id", "type", *feature_names())


def stream_reading_scores(spark, d):
    """Every reading of the stream scored from its rolling features: rows and probabilities per type."""
    rows = materialize(cleaned(spark, d), "cleaned")
    model = bounded_forest(training.feature_table(rows))
    sink = RollingSink(new_folder(spark, "scored"), score=model.score)
    in_stages([rows], sink, "readings")
    return sink.read(spark).groupBy("type").agg(
        F.countDistinct("unit_id").alias("rows"), F.count_if(F.col("failure_probability").between(0, 1)).alias("probabilities")
    )


def _with_stragglers(spark, d, sink):
    rows = cleaned(spark, d)
    in_stages([rows.filter("unit_id % 29 <> 0"), rows.filter("unit_id % 29 = 0")], sink, "stragglers")
    return sink


def stream_late_rows(spark, d):
    """Every 29th reading arrives after all others: late unless it is its vehicle's newest."""
    sink = RollingSink(new_folder(spark, "late"), ["vehicle_id"], ["ts", "unit_id"])
    return _with_stragglers(spark, d, sink).read(spark, "late").select("vehicle_id", "unit_id")


def stream_vehicle_features(spark, d):
    """Many small keys: list state per vehicle."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    rows = cleaned(spark, d).select("*", F.unix_micros("ts").alias("at"))
    folder, source = new_folder(spark, "vehicles"), new_folder(spark, "vehicle-readings")
    rows.write.parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source)
    out = keyed_rolling(stream, "vehicle_id", ["at", "unit_id"])
    start(out, lambda df, i: write_batch(df, folder, i), new_folder(spark, "vehicle-checkpoint")).awaitTermination()
    return spark.read.parquet(folder).select("vehicle_id", "unit_id", *feature_names())


def stream_reordered_features(spark, d):
    """Readings come up to two days late, in three parts: the buffer hands them on in order, so features equal the batch."""
    late = 2 * 86_400
    rows = cleaned(spark, d).select("vehicle_id", "unit_id", "ts", *SENSORS)  # what features are made of and known by
    rows = rows.withColumn("arrived", F.unix_seconds("ts") + F.pmod(F.xxhash64("unit_id"), F.lit(late)))
    rows = materialize(rows.repartition("unit_id"), "arrivals")  # else a part's span of time sits in a few files
    first, last = rows.agg(F.min("arrived"), F.max("arrived")).first()
    third = ((last or 0) - (first or 0)) // 3 + 1
    sink = RollingSink(new_folder(spark, "reordered"), ["vehicle_id"], ["ts", "unit_id"], columns=["vehicle_id", "unit_id"])
    buffer = ReorderBuffer(new_folder(spark, "waiting"), sink, late)
    part = F.expr(f"(arrived - {first or 0}) div {third}")
    in_stages([rows.filter(part == i).drop("arrived") for i in range(3)], buffer, "arrivals")
    buffer.close(spark, 2)
    return sink.read(spark).select("vehicle_id", "unit_id", *feature_names())


def stream_reconcile(spark, d):
    """Both logs of ``log_reconcile`` live: what one lacks comes out when its time is over; a last line without marker ends the logs."""
    ev = materialize(tables.events(spark, d).select(F.concat(F.lit("veh-"), F.col("event_id")).alias("marker"), "event_id", "ts"), "markers")
    end = ev.agg(F.lit(None).cast("string").alias("marker"), (F.max("ts") + F.expr("INTERVAL 1 day")).alias("ts"))
    folders = [new_folder(spark, n) for n in ("left-log", "right-log")]
    out, checkpoint = new_folder(spark, "reconciled"), new_folder(spark, "reconcile-checkpoint")
    logs = [ev.filter("event_id % 17 <> 0").drop("event_id"), ev.filter("event_id % 13 <> 0").drop("event_id")]
    for parts in (logs, [end, end]):
        for part, folder in zip(parts, folders):
            part.select("marker", "ts").write.mode("append").parquet(folder)
        left, right = (spark.readStream.schema(logs[0].schema).parquet(f) for f in folders)
        start(live_reconcile(left, right, "marker"), lambda df, i: write_batch(df, out, i), checkpoint).awaitTermination()
    return spark.read.parquet(out).select("marker", "status")


def _requests(spark, d, sink):
    bodies = tables.request_bodies(tables.telemetry(spark, d))
    in_stages([bodies], sink, "requests")
    return sink


def stream_rejections(spark, d):
    sink = _requests(spark, d, RequestSink(new_folder(spark, "request-sink")))
    return rejection_errors(spark.read.parquet(sink.rejected), ["request_id"])


def stream_request_scores(spark, d):
    """The accepted requests, scored: rows, readings used and probabilities per version."""
    model = bounded_forest(training.feature_table(materialize(cleaned(spark, d), "cleaned")))
    sink = RequestSink(new_folder(spark, "score-sink"), model.score)
    out = spark.read.parquet(_requests(spark, d, sink).accepted)
    return out.groupBy("model_version").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("readings_used").alias("readings"), F.count_if(F.col("failure_probability").between(0, 1)).alias("probabilities")
    )


def log_to_drift(spark, d):
    """Requests are scored on a stream, and the drift job reads the log that this leaves."""
    sink = RequestSink(new_folder(spark, "log-sink"), lambda df: df.withColumn("score", F.lit(0.25)))
    lines = spark.read.text(_requests(spark, d, sink).log)
    return files.prediction_log(lines).groupBy("type").agg(F.count(F.lit(1)).alias("rows"), *[F.avg(c).alias(c) for c in SENSORS])


def _live(spark, d, metric, keys):
    folder = new_folder(spark, "live")
    live(tables.request_log(event_stream(spark, d)), metric, folder, new_folder(spark, "live-checkpoint")).awaitTermination()
    return current_values(spark, folder, keys)


def stream_status_mix(spark, d):
    return _live(spark, d, oplog.status_mix, ["window_start", "status"])


def stream_throughput(spark, d):
    return _live(spark, d, oplog.throughput, ["window_start", "path"])


def stream_error_rate(spark, d):
    return _live(spark, d, oplog.error_rate, ["window_start"])


def stream_latency_quantiles(spark, d):
    """Buckets are kept live; the later half of the log comes after a restart, quantiles are read off at the end."""
    log = materialize(tables.request_log(tables.events(spark, d)), "log")
    middle = F.lit(log.agg(F.timestamp_micros(((F.unix_micros(F.min("ts")) + F.unix_micros(F.max("ts"))) / 2).cast("long"))).first()[0])
    source, folder, checkpoint = (new_folder(spark, n) for n in ("latency", "live", "live-checkpoint"))
    for part in (log.filter(F.col("ts") < middle), log.filter(F.col("ts") >= middle)):
        part.write.mode("append").parquet(source)
        live(spark.readStream.schema(log.schema).parquet(source), oplog.latency_buckets, folder, checkpoint).awaitTermination()
    return oplog.quantiles_of_buckets(current_values(spark, folder, ["window_start"]))


def stream_drift(spark, d):
    """The window is as many days as the current rows span."""
    reference, current = drift_frames(spark, d)
    current = materialize(current, "current")
    days = current.agg(F.datediff(F.max("ts"), F.min("ts")) + 1).first()[0] or 1
    sink = DriftSink(new_folder(spark, "drift"), reference, days)
    in_stages([current], sink, "scored")
    return flat_summary(spark.read.parquet(sink.summaries).drop("batch", "as_of"))


def stream_queries() -> dict:
    return {
        f.__name__: f
        for f in (
            stream_rolling_features, stream_reading_scores, stream_late_rows, stream_vehicle_features, stream_reordered_features, stream_reconcile, stream_rejections,
            stream_request_scores, log_to_drift, stream_status_mix, stream_throughput, stream_error_rate, stream_latency_quantiles,
            stream_drift,
        )
    }
