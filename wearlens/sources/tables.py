"""Telemetry, request and run tables derived from the ``events`` table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wearlens.contract import RAW_TO_WORKING, SENSORS


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def from_events(df: DataFrame) -> DataFrame:
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry_of(events(spark, sf_dir))


def telemetry_of(ev: DataFrame) -> DataFrame:
    """Readings with planted faults: one per event, for checking operators only."""
    eid = F.col("event_id")

    def flag(cond: Column) -> Column:
        return F.when(cond, 1).otherwise(0)

    readings = ev.select(
        (eid + 1).alias("unit_id"),
        F.col("user_id").alias("vehicle_id"),
        F.when(eid % 79 == 0, "X")
        .when(F.col("event_type") == "view", "M")
        .when(F.col("event_type") == "purchase", "H")
        .otherwise("L")
        .alias("type"),
        F.when(eid % 101 == 0, "not-a-timestamp")
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .alias("recorded_at"),
        # props is an object with the one number k; a pattern costs a fraction of a JSON parse
        F.regexp_extract("props", r'"k": *(\d+)', 1).cast("int").alias("k"),
        F.when(eid % 83 != 0, F.col("value")).alias("torque_nm"),
        (eid % 254).cast("int").alias("tool_wear_min"),
        F.when(eid % 89 == 0, -500).otherwise((1300 + (eid * 37) % 600).cast("int")).alias("rotational_speed_rpm"),
        eid.alias("event_id"),
        "ts",
    ).withColumns(
        {
            "air_temperature_k": F.when(F.col("event_id") % 97 == 0, 999.9).otherwise(295.0 + F.col("k") / 10.0),
            "process_temperature_k": 305.0 + ((F.col("k") * 7) % 100) / 12.5,
            "product_id": F.concat("type", F.lpad((F.col("event_id") % 100000).cast("string"), 5, "0")),
        }
    )
    torque, wear = F.col("torque_nm"), F.col("tool_wear_min")
    flags = {
        "twf": flag(wear > 248),
        "hdf": flag(F.col("k") > 97),
        "pwf": flag(torque * F.col("rotational_speed_rpm") > 250000.0),
        "osf": flag((torque > 110.0) & (wear > 150)),
        "rnf": flag(F.col("event_id") % 1000 == 0),
    }
    label = F.greatest(*flags)
    noise = ((F.col("event_id") * 7919) % 1000) / 1000.0
    return (
        readings.withColumns(flags)
        .withColumn("machine_failure", label)
        .select(
            "unit_id", "vehicle_id", "product_id", "type", "recorded_at", *SENSORS, "machine_failure",
            *flags, (0.3 * F.col("machine_failure") + 0.7 * noise).alias("failure_probability"), "ts",
        )
    )


def raw_layout(readings: DataFrame) -> DataFrame:
    """The telemetry under the 14 column names of the raw file."""
    return readings.select(*[F.col(w).alias(r) for r, w in RAW_TO_WORKING.items()])


READINGS_PER_REQUEST = 8


def request_bodies(readings: DataFrame) -> DataFrame:
    """``request_id, body``: JSON scoring requests of up to eight consecutive readings.

    Null sensors leave their key out of the JSON, and further breakage is planted by request id.
    A group holds eight readings at most because it is a range of the unique reading id.
    """
    rid = F.floor((F.col("unit_id") - 1) / READINGS_PER_REQUEST)
    sensors = F.struct(*[F.col(c) for c in SENSORS])
    grouped = (
        readings.withColumn("request_id", rid)
        .groupBy("request_id")
        .agg(
            F.array_sort(F.collect_list(F.struct("unit_id", sensors.alias("s")))).alias("w"),
            F.min_by("type", "unit_id").alias("type"),
            F.max("ts").alias("ts"),
        )
    )
    rid = F.col("request_id")
    good = F.to_json(
        F.struct(
            F.concat(F.lit("veh-"), rid).alias("vehicle_id"),
            F.col("type"),
            F.transform("w", lambda r: r["s"]).alias("telemetry_window"),
        )
    )
    body = (
        F.when(rid % 41 == 0, F.regexp_replace(good, r'"telemetry_window":\[.*\]', '"telemetry_window":[]'))
        .when(rid % 43 == 0, F.regexp_replace(good, r'"air_temperature_k":[0-9.]+', '"air_temperature_k":"hot"'))
        .when(rid % 47 == 0, F.regexp_replace(good, r'"vehicle_id":"[^"]*"', '"vehicle_id":""'))
        .when(rid % 53 == 0, F.substring(good, 1, 20))
        .otherwise(good)
    )
    return grouped.select("request_id", "ts", body.alias("body"))


def request_log(ev: DataFrame) -> DataFrame:
    """Handled-request records: path and status from the event type, duration from the value."""
    return ev.select(
        F.col("event_id").alias("request_id"),
        "ts",
        F.when(F.col("event_type") == "signup", "/health").otherwise("/predict").alias("path"),
        F.when(F.col("event_type") == "error", 500)
        .when(F.col("event_id") % 11 == 0, 422)
        .otherwise(200)
        .alias("status_code"),
        F.col("value").alias("duration_ms"),
    )


def prediction_log_lines(readings: DataFrame) -> DataFrame:
    """``value``: JSON log lines of scored readings, with planted unusable lines."""
    uid = F.col("unit_id")
    features = F.when(uid % 61 != 0, F.struct(*SENSORS))
    line = F.to_json(
        F.struct(
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
            F.lit("INFO").alias("level"),
            F.when(uid % 59 == 0, "request_handled").otherwise("prediction_made").alias("event"),
            F.concat(F.lit("veh-"), F.col("vehicle_id")).alias("vehicle_id"),
            F.col("type").alias("machine_type"),
            F.lit(1).alias("readings_used"),
            "failure_probability",
            F.when(uid % 3 == 0, "1").otherwise("2").alias("model_version"),
            features.alias("features"),
        ),
        {"ignoreNullFields": "false"},
    )
    return readings.select(
        F.when(uid % 53 == 0, F.substring(line, 1, 25)).when(uid % 67 == 0, F.lit("  ")).otherwise(line).alias("value")
    )


def probe_lines(ev: DataFrame) -> DataFrame:
    """``value``: rollout probe log lines, one per event."""
    return ev.select(
        F.concat(
            F.date_format("ts", "HH:mm:ss"), F.lit(".3N code="),
            F.when(F.col("event_type") == "error", "500").otherwise("200"),
            F.lit(" api_version="),
            rollout_version(),
        ).alias("value")
    )


def rollout_version() -> Column:
    """Version a probe saw: none for a third of the days, mixed for a third, then the new one."""
    day = F.dayofmonth("ts")
    return (
        F.when((day <= 10) | ((day <= 20) & (F.col("event_id") % 2 == 0)), "None").otherwise("1.1.0")
    )


def scored(readings: DataFrame) -> DataFrame:
    """``unit_id, type, label, score`` as every metric operator takes them."""
    return readings.select(
        "unit_id", "type", F.col("machine_failure").alias("label"), F.col("failure_probability").alias("score")
    )
