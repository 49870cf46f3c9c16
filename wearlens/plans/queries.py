"""Every operator as a query over the given tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, functions as F, types as T

from wearlens.contract import LABEL, MACHINE_TYPES, SENSORS, feature_names
from wearlens.operators import (
    audits, cleaning, deliveries, drift, metrics, oplog, profiling, requests, runs, splits, validation,
    rolling as roll,
)
from wearlens.operators.isotonic import IsotonicMap
from wearlens.session import new_folder
from wearlens.sources import committed, daily, files, tables

AS_OF = "2024-01-31 00:00:00"
CURRENT_FROM = "2024-01-16 00:00:00"  # the two drift windows meet here and cover all rows
THRESHOLD = 0.27
RUN_THRESHOLDS = [0.27, 0.5, 0.6]
SMALL_SLICE = 2000


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded and timestamps as text, so that two engines can be compared."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType):
            c = F.round(c, digits) + F.lit(0.0)
        elif isinstance(f.dataType, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        out.append(c.alias(f.name))
    return df.select(*out)


def telemetry(spark, d):
    return tables.telemetry(spark, d)


def cleaned(spark, d):
    return cleaning.clean(telemetry(spark, d))


def scored(spark, d):
    return tables.scored(cleaned(spark, d))


def labelled(spark, d):
    return cleaned(spark, d).select("unit_id", "type", F.col(LABEL).alias("label"))


def request_log(spark, d):
    return tables.request_log(tables.events(spark, d))


def metric_series(spark, d):
    """A metric series per vehicle: the event value scaled to shares."""
    return tables.events(spark, d).select(
        F.col("user_id").alias("series"), "ts", "event_id", (F.col("value") / 100.0).alias("value")
    )


def probes(spark, d):
    """Probe records with full timestamps."""
    return tables.events(spark, d).select(
        "event_id", "ts",
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"),
        tables.rollout_version().alias("api_version"),
    )


def drift_frames(spark, d):
    frame = cleaned(spark, d).select(
        "unit_id", *SENSORS, "type", F.col("failure_probability").alias("prediction"), "ts"
    )
    at = F.col("ts")
    return (
        frame.filter(at < F.lit(CURRENT_FROM).cast("timestamp")),
        frame.filter(at >= F.lit(CURRENT_FROM).cast("timestamp")),
    )


def run_table(spark, d):
    """One run per vehicle and threshold: odd readings validate, even ones test. Ten vehicles are a batch."""
    base = cleaned(spark, d).select(
        "vehicle_id", "unit_id", F.col(LABEL).alias("label"), F.col("failure_probability").alias("score")
    )
    each = base.withColumn("__t", F.explode(F.array(*[F.lit(t) for t in RUN_THRESHOLDS])))
    part = F.when(F.col("unit_id") % 2 == 1, "val").otherwise("test")
    cells = metrics.rates(
        metrics.confusion(each.withColumn("part", part), F.col("__t"), ["vehicle_id", "__t", "part"])
    )

    def of(p, c):
        return F.max(F.when(F.col("part") == p, F.col(c))).alias(f"{p}_{c}")

    wide = cells.groupBy("vehicle_id", "__t").agg(
        *[of("val", c) for c in ("recall", "precision", "f2_score", "expected_cost_per_1000")],
        of("test", "expected_cost_per_1000"),
    )
    ranks = metrics.ranking_metrics(base.filter(F.col("unit_id") % 2 == 1), ["vehicle_id"]).select(
        "vehicle_id", F.col("pr_auc").alias("val_pr_auc")
    )
    seq = F.col("vehicle_id") * len(RUN_THRESHOLDS) + F.array_position(
        F.array(*[F.lit(t) for t in RUN_THRESHOLDS]), F.col("__t")
    )
    batch = F.floor(F.col("vehicle_id") / 10)
    return wide.join(ranks, "vehicle_id", "left").filter(f"{runs.COST} is not null").select(
        F.concat(F.lit("run-"), seq.cast("string")).alias("run_id"),
        F.concat(F.lit("batch-"), F.lpad(batch.cast("string"), 4, "0")).alias("batch_id"),
        batch.alias("batch_no"),
        seq.alias("seq"),
        *[c for c in wide.columns if c not in ("vehicle_id", "__t")],
        "val_pr_auc",
    )


# --- sources ---------------------------------------------------------------------------


def read_raw(spark, d):
    path = new_folder(spark, "raw")
    tables.raw_layout(telemetry(spark, d)).write.option("header", True).csv(path)
    return files.load_raw(spark, path)


def validated_dataset(spark, d):
    """From raw files through cleaning and the gate, types included, to the written table read back."""
    rows = cleaning.clean(files.to_working_schema(read_raw(spark, d)))
    path = new_folder(spark, "validated")
    valid, failures = files.write_if_valid(rows.filter(F.col("type").isin(MACHINE_TYPES)), path)
    if not valid:
        raise ValueError(f"the contract failed: {failures.collect()}")
    return files.load_cleaned(spark, path).select("unit_id", "type", *SENSORS, LABEL)


def working_schema(spark, d):
    return files.to_working_schema(tables.raw_layout(telemetry(spark, d)))


def null_tripwire(spark, d):
    return files.null_tripwire(telemetry(spark, d), ["unit_id", "type", *SENSORS, LABEL])


def training_frame(spark, d):
    return files.training_frame(cleaned(spark, d))


def prediction_log_flat(spark, d):
    return files.prediction_log(tables.prediction_log_lines(telemetry(spark, d)))


def prediction_log_window(spark, d):
    lines = tables.prediction_log_lines(telemetry(spark, d))
    return files.prediction_log(lines, as_of=AS_OF, window_minutes=10 * 24 * 60, model_version="2")


def prediction_log_daily(spark, d):
    """The same window read from a log laid out by day."""
    path, minutes = new_folder(spark, "daily-log"), 10 * 24 * 60
    daily.write_log_daily(tables.prediction_log_lines(telemetry(spark, d)), path)
    return files.prediction_log(daily.read_log_since(spark, path, AS_OF, minutes), as_of=AS_OF, window_minutes=minutes, model_version="2")


def probe_log_parse(spark, d):
    return files.probe_log(tables.probe_lines(tables.events(spark, d)))


def runs_by_batch(spark, d):
    return runs.runs_of_batch(run_table(spark, d), "batch-0001")


# --- cleaning and contract ---------------------------------------------------------------


def clean_report(spark, d):
    return cleaning.clean_report_items(cleaning.clean_report(telemetry(spark, d)))


def quarantine(spark, d):
    rows = cleaning.quarantine(telemetry(spark, d))
    return rows.select("unit_id", F.array_join("reasons", ",").alias("reasons"))


def doubled(spark, d):
    """The telemetry with every 500th reading repeated."""
    df = telemetry(spark, d)
    return df.unionByName(df.filter(F.col("unit_id") % 500 == 0))


def contract_failures(spark, d):
    return validation.contract_failures(doubled(spark, d))


def checked_requests(spark, d):
    return requests.check_requests(tables.request_bodies(telemetry(spark, d)))


def request_contract(spark, d):
    return requests.rejection_errors(checked_requests(spark, d), ["request_id"])


def request_features(spark, d):
    return requests.request_features(requests.accepted(checked_requests(spark, d))).drop("ts")


def action_tier(spark, d):
    return telemetry(spark, d).select("unit_id", cleaning.action_tier("failure_probability").alias("action"))


def action_mix(spark, d):
    return action_tier(spark, d).groupBy("action").agg(F.count(F.lit(1)).alias("rows"))


# --- rolling features --------------------------------------------------------------------


def rolling_of(which, spark, d, **options):
    out = roll.rolling_features(cleaned(spark, d), which=which, **options)
    return out.select("unit_id", "type", *[c for c in out.columns if "_roll" in c or c.endswith("_roc")])


def rolling_by_vehicle(spark, d):
    """Per-vehicle streams in time order, wide windows."""
    out = roll.rolling_features(cleaned(spark, d), ["vehicle_id"], ["ts", "unit_id"], windows=(5, 10))
    return out.select("vehicle_id", "unit_id", *feature_names(windows=(5, 10)))


# --- runs ---------------------------------------------------------------------------------


def champion(spark, d):
    table = run_table(spark, d)
    history = runs.promotion_history(table)
    versions = history.select(
        F.col("candidate_version").alias("version"), F.col("candidate_run_id").alias("run_id")
    )
    return runs.champion(runs.alias_events(history), versions, table)


def what_if(spark, d):
    def formula(df):
        return df.withColumn("score", 0.5 * F.col("torque_nm") / 150.0 + 0.5 * F.col("tool_wear_min") / 400.0)

    return oplog.paired_scores(
        cleaned(spark, d).select("unit_id", "torque_nm", "tool_wear_min"),
        "unit_id",
        {
            "baseline": {},
            "escalated": {
                "torque_nm": F.least(F.col("torque_nm") + 20.0, F.lit(150.0)),
                "tool_wear_min": F.least(F.col("tool_wear_min") + 100, F.lit(400)),
            },
        },
        formula,
    )


def log_reconcile(spark, d):
    ev = tables.events(spark, d).select(F.concat(F.lit("veh-"), F.col("event_id")).alias("marker"), "event_id")
    return oplog.reconcile(ev.filter("event_id % 17 <> 0"), ev.filter("event_id % 13 <> 0"), "marker")


# --- splits and metrics ------------------------------------------------------------------


def split_of(spark, d):
    return splits.stratified_split(labelled(spark, d))


def isotonic_fit(spark, d):
    """The share of failures as it can only grow with wear: fitted over ranges of 32 values, then read at every row's wear."""
    rows = cleaned(spark, d).filter(F.col(LABEL).isNotNull())
    fitted = IsotonicMap.fit(rows, "tool_wear_min", LABEL, rows_per_range=32, few=0)
    return fitted.transform(rows, "tool_wear_min", "value").groupBy("tool_wear_min").agg(F.count(F.lit(1)).alias("rows"), F.first("value").alias("value"))


def folds_of(spark, d):
    return splits.stratified_folds(labelled(spark, d))


def split_audit(spark, d):
    """Folds of every vehicle's own readings: small slices, some without positives."""
    part = cleaned(spark, d).select(
        F.concat_ws("/", "vehicle_id", (F.col("unit_id") % 5)).alias("split"), F.col(LABEL).alias("label")
    )
    return splits.split_audit(part)


def report(spark, d, groups=()):
    return metrics.classification_report(scored(spark, d), THRESHOLD, list(groups))


def ranking(column, spark, d):
    return metrics.ranking_metrics(scored(spark, d)).select(column, "reason")


# --- drift --------------------------------------------------------------------------------


def drift_numeric(spark, d, columns):
    return drift.numeric_drift(*drift_frames(spark, d)).select("column", *columns)


def drift_psi(spark, d):
    return drift.psi(*drift_frames(spark, d))


def flat_summary(summary: DataFrame) -> DataFrame:
    return summary.drop("per_column_drift")


def drift_summary(spark, d):
    return flat_summary(drift.drift_summary(*drift_frames(spark, d)))


def drift_cold_columns(spark, d):
    reference, current = drift_frames(spark, d)
    return drift.drift_by_column(reference, drift.cold_shift(current))


def drift_cold_summary(spark, d):
    return flat_summary(drift.summarize(drift_cold_columns(spark, d)))


def drift_by_window(spark, d):
    reference, current = drift_frames(spark, d)
    return flat_summary(drift.drift_by_window(reference, current, [360, 1440, 7200], AS_OF))


def cold_shift(spark, d):
    return drift.cold_shift(cleaned(spark, d)).select("unit_id", *drift.COLD_SHIFT)


# --- request log ---------------------------------------------------------------------------


def latest_metric(spark, d):
    return oplog.latest_metric(metric_series(spark, d), ["series"], ["ts", "event_id"])


def alert_state(spark, d):
    return oplog.alert_state(
        metric_series(spark, d), ["series"], AS_OF, lookback_minutes=1440, order=["ts", "event_id"]
    )


def alert_state_daily(spark, d):
    """The alert's own ten minutes, of a series laid out by day."""
    path = new_folder(spark, "daily-series")
    daily.write_daily(metric_series(spark, d), path)
    recent = daily.read_lookback(spark, path, AS_OF, 10)
    return oplog.alert_state(recent, ["series"], AS_OF, order=["ts", "event_id"], names=metric_series(spark, d))


def appended_twice(spark, d):
    """Two batches of readings, the second sent again after its commit, then a replacement by what is in the table and valid."""
    rows, path = telemetry(spark, d).select("unit_id", "type"), new_folder(spark, "committed")
    sent = [files.append_rows(rows.filter(f"unit_id % 2 = {k}"), path, f"part {k}") for k in (0, 1, 1)]
    committed.replace(committed.read(spark, path).filter(F.col("type").isin(MACHINE_TYPES)), path, "valid")
    return committed.read(spark, path).groupBy("type").agg(F.count(F.lit(1)).alias("rows"), F.lit(sum(sent)).alias("batches"))


def delivered_before(spark, d):
    """Two deliveries that overlap: the ids of the second that the index of the first holds, and whether it was refused."""
    rows = cleaning.clean(telemetry(spark, d)).filter(F.col("type").isin(MACHINE_TYPES))
    table, index = new_folder(spark, "delivered"), new_folder(spark, "delivered-ids")
    deliveries.accept_delivery(rows.filter("unit_id % 3 <> 0"), table, index, "first")
    second = rows.filter("unit_id % 3 = 0 or unit_id % 100 = 1")
    accepted, _ = deliveries.accept_delivery(second, table, index, "second")
    return deliveries.seen_before(second, deliveries.known_ids(spark, index)).withColumn("accepted", F.lit(accepted))


def with_queries(op, source, select=None, **options):
    def query(spark, d):
        out = op(source(spark, d), **options)
        return out if select is None else out.select(*select)

    return query


def batch_queries() -> dict:
    sensors_frame = lambda s, d: cleaned(s, d).select("unit_id", "type", *SENSORS)
    failures = contract_failures
    return {
        "read_raw": read_raw,
        "working_schema": working_schema,
        "null_tripwire": null_tripwire,
        "validated_dataset": validated_dataset,
        "training_frame": training_frame,
        "prediction_log_flat": prediction_log_flat,
        "prediction_log_window": prediction_log_window,
        "prediction_log_daily": prediction_log_daily,
        "appended_twice": appended_twice,
        "delivered_before": delivered_before,
        "probe_log_parse": probe_log_parse,
        "runs_by_batch": runs_by_batch,
        "drop_missing": lambda s, d: cleaning.drop_missing(telemetry(s, d)).drop("ts"),
        "null_counts": with_queries(cleaning.null_counts, telemetry),
        "drop_bad_timestamps": lambda s, d: cleaning.drop_bad_timestamps(telemetry(s, d)).select("unit_id", "recorded_at"),
        "drop_outliers": lambda s, d: cleaning.drop_outliers(telemetry(s, d)).drop("ts"),
        "outlier_counts": with_queries(cleaning.outlier_counts, telemetry),
        "clean_dataset": lambda s, d: cleaned(s, d).drop("ts"),
        "clean_report": clean_report,
        "quarantine": quarantine,
        "request_contract": request_contract,
        "action_tier": action_tier,
        "action_mix": action_mix,
        "contract_failures": contract_failures,
        "duplicate_ids": with_queries(validation.duplicate_ids, doubled),
        "failures_by_check": with_queries(validation.failures_by_check, failures),
        "failure_sample": with_queries(validation.failure_sample, failures),
        "numeric_profile": with_queries(profiling.numeric_profile, cleaned),
        "type_counts": with_queries(profiling.value_counts, cleaned, column="type"),
        "label_balance": with_queries(profiling.label_balance, cleaned),
        "missingness": lambda s, d: profiling.missingness(telemetry(s, d).drop("ts")),
        "rolling_mean": partial(rolling_of, ("rollmean",)),
        "rolling_std": partial(rolling_of, ("rollstd",)),
        "rate_of_change": partial(rolling_of, ("roc",)),
        "rolling_features": partial(rolling_of, ("rollmean", "rollstd", "roc")),
        "rolling_features_blocked": partial(rolling_of, ("rollmean", "rollstd", "roc"), rows_per_slice=SMALL_SLICE),
        "rolling_by_vehicle": rolling_by_vehicle,
        "stream_prefix": lambda s, d: roll.stream_prefix(sensors_frame(s, d), 37),
        "request_features": request_features,
        "feature_parity": with_queries(roll.feature_parity, sensors_frame),
        "cold_start_skew": with_queries(roll.cold_start_skew, sensors_frame),
        "boundary_leak": with_queries(roll.boundary_leak, sensors_frame),
        "leaderboard": lambda s, d: runs.leaderboard(run_table(s, d)).select("batch_id", "run_id", runs.COST, "rank"),
        "select_best": with_queries(runs.select_best, run_table),
        "runner_up": with_queries(runs.runner_up, run_table),
        "gate_stats": with_queries(runs.gate_stats, run_table),
        "champion_challenger": with_queries(runs.promotion_history, run_table),
        "alias_events": lambda s, d: runs.alias_events(runs.promotion_history(run_table(s, d))),
        "champion": champion,
        "log_reconcile": log_reconcile,
        "what_if": what_if,
        "reference_sample": lambda s, d: splits.reference_sample(sensors_frame(s, d), 2000),
        "stratified_split": split_of,
        "stratified_folds": folds_of,
        "split_report": with_queries(splits.split_report, split_of),
        "split_audit": split_audit,
        "class_weights": with_queries(splits.class_weights, labelled),
        "confusion": lambda s, d: metrics.confusion(scored(s, d), THRESHOLD),
        "threshold_scan": with_queries(metrics.threshold_scan, scored),
        "best_threshold": with_queries(metrics.best_threshold, scored),
        "classification_report": report,
        "average_precision": partial(ranking, "pr_auc"),
        "roc_auc": partial(ranking, "roc_auc"),
        "isotonic_fit": isotonic_fit,
        "brier": lambda s, d: scored(s, d).agg(metrics.brier().alias("brier_score")),
        "expected_cost": lambda s, d: report(s, d).select("threshold", "expected_cost_per_1000"),
        "error_rates": lambda s, d: report(s, d).select("fn_rate", "fp_rate", "n_samples", "n_positive"),
        "report_by_type": lambda s, d: report(s, d, ["type"]),
        "drift_wasserstein": partial(drift_numeric, columns=["wasserstein", "ref_rows", "cur_rows"]),
        "drift_ks": partial(drift_numeric, columns=["ks", "ks_p"]),
        "drift_js": lambda s, d: drift.categorical_drift(*drift_frames(s, d)),
        "drift_psi": drift_psi,
        "drift_by_column": lambda s, d: drift.drift_by_column(*drift_frames(s, d)),
        "drift_summary": drift_summary,
        "drift_cold_columns": drift_cold_columns,
        "drift_cold_summary": drift_cold_summary,
        "drift_by_window": drift_by_window,
        "cold_shift": cold_shift,
        "latency_quantiles": with_queries(oplog.latency_quantiles, request_log, every="1 hour"),
        "latency_histogram_quantiles": with_queries(oplog.histogram_quantiles, request_log),
        "throughput": with_queries(oplog.throughput, request_log),
        "error_rate": with_queries(oplog.error_rate, request_log),
        "error_rate_sliding": with_queries(oplog.error_rate, request_log, slide="1 minute"),
        "status_mix": with_queries(oplog.status_mix, request_log),
        "latest_metric": latest_metric,
        "alert_state": alert_state,
        "alert_state_daily": alert_state_daily,
        "series_gaps": with_queries(oplog.series_gaps, metric_series, by=["series"], id_col="event_id"),
        "asof_fill": with_queries(oplog.asof_fill, metric_series, by=["series"], id_col="event_id", step_seconds=60),
        "rejection_rate": with_queries(oplog.rejection_rate, checked_requests),
        "latency_summary": with_queries(oplog.latency_summary, request_log),
        "latency_histogram": with_queries(oplog.latency_histogram, request_log),
        "version_timeline": with_queries(oplog.version_timeline, probes),
        "version_changes": with_queries(oplog.version_changes, probes, id_col="event_id"),
        "leak_audit": with_queries(audits.leak_audit, cleaned),
        "bad_input_audit": with_queries(audits.bad_input_audit, telemetry),
    }
