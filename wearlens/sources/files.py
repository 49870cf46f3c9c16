"""Readers for raw files and logs, and gated or append-only writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wearlens.contract import (
    FAILURE_FLAGS, LABEL, RAW_SCHEMA, RAW_TO_WORKING, SENSORS, require_columns,
)
from wearlens.operators.cleaning import absent
from wearlens.sources import committed

PREDICTION_SCHEMA = (
    "timestamp STRING, level STRING, event STRING, vehicle_id STRING, machine_type STRING, "
    "readings_used INT, failure_probability DOUBLE, recommended_action STRING, model_version STRING, "
    "features STRUCT<air_temperature_k: DOUBLE, process_temperature_k: DOUBLE, "
    "rotational_speed_rpm: DOUBLE, torque_nm: DOUBLE, tool_wear_min: DOUBLE>"
)


# fixed values: the spellings of a missing value in text files, numbers and words alike
MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
]


def load_raw(spark: SparkSession, path: str) -> DataFrame:
    """The raw CSV as it is. Spark drops a byte-order mark; a missing path raises."""
    header = spark.read.option("header", True).csv(path).columns
    missing = [c for c in RAW_TO_WORKING if c not in header]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    declared = {f.name: f.dataType for f in T.StructType.fromDDL(RAW_SCHEMA)}
    text = T.StructType([T.StructField(c, T.StringType()) for c in header])
    # a later file whose header differs is refused, not read by position
    raw = spark.read.option("header", True).option("enforceSchema", False).schema(text).csv(path)

    def typed(name):
        kind = declared.get(name, T.StringType())
        value = F.col(f"`{name}`") if isinstance(kind, T.StringType) else F.trim(F.col(f"`{name}`"))
        return F.when(~value.isin(MISSING), value).cast(kind).alias(name)  # any other non-number is an error

    return raw.select(*[typed(c) for c in header])


def to_working_schema(df: DataFrame) -> DataFrame:
    require_columns(df, RAW_TO_WORKING)
    return df.withColumnsRenamed(RAW_TO_WORKING)


def load_cleaned(spark: SparkSession, path: str) -> DataFrame:
    """Cleaned Parquet with its required columns; raises when any of them holds a null."""
    df = committed.read(spark, path) if committed.is_committed(spark, path) else spark.read.parquet(path)
    needed = ["unit_id", "type", *SENSORS, LABEL]
    require_columns(df, needed)
    found = null_tripwire(df, needed).filter("nulls > 0").collect()
    if found:
        raise ValueError("nulls in cleaned data: " + ", ".join(f"{r['column']}={r['nulls']}" for r in found))
    return df


def null_tripwire(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column, nulls`` for every named column, from one aggregate; NaN counts as null."""
    require_columns(df, columns)
    counts = df.agg(*[F.count_if(absent(df, c)).alias(c) for c in columns])
    return counts.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in columns]))
    )


def training_frame(df: DataFrame, features: list[str] | None = None) -> DataFrame:
    """Features, category and integer label. Failure-mode flags restate the label, so they are refused."""
    features = list(features or SENSORS)
    leaking = [c for c in features if c in FAILURE_FLAGS]
    if leaking:
        raise ValueError(f"failure-mode flags leak the label: {leaking}")
    require_columns(df, ["unit_id", "type", LABEL, *features])
    return df.select("unit_id", "type", *features, F.col(LABEL).cast("int").alias("label"))


def prediction_log(
    lines: DataFrame, mode: str = "permissive", as_of=None, window_minutes: int | None = None,
    model_version: str | None = None,
) -> DataFrame:
    """Drift columns from JSON log lines (column ``value``).

    ``permissive`` skips malformed lines, other events and predictions whose features are absent or
    empty (a reading with a null sensor counts), and may restrict to a lookback from ``as_of`` and to one model version. ``failfast`` skips blank lines
    only and raises on anything it cannot read.
    """
    if mode not in ("permissive", "failfast"):
        raise ValueError(f"unknown mode {mode!r}")
    lines = lines.filter(F.length(F.trim("value")) > 0)
    options = {"mode": "FAILFAST"} if mode == "failfast" else {}
    parsed = lines.select(
        F.from_json("value", PREDICTION_SCHEMA, options).alias("p"), F.from_json("value", "features MAP<STRING, STRING>").alias("m")
    ).select("p.*", F.coalesce(F.size("m.features"), F.lit(0)).alias("named"))
    if mode == "permissive":
        # a line that names no feature is no prediction to compare; a named feature may be null
        parsed = parsed.filter((F.col("event") == "prediction_made") & (F.col("named") > 0))
        if window_minutes is not None:
            at = F.try_to_timestamp("timestamp")
            end = F.lit(as_of).cast("timestamp")
            parsed = parsed.filter(at >= end - F.make_dt_interval(mins=F.lit(window_minutes)))
        if model_version is not None:
            parsed = parsed.filter(F.col("model_version") == model_version)
    else:
        present = F.when(
            F.col("features").isNull(), F.raise_error(F.lit("prediction line without features"))
        ).otherwise(F.lit(True))
        parsed = parsed.filter(present)
    return parsed.select(
        *[F.col(f"features.{c}").alias(c) for c in SENSORS],
        F.col("machine_type").alias("type"),
        F.col("failure_probability").alias("prediction"),
    )


def probe_log(lines: DataFrame) -> DataFrame:
    """``clock, status, api_version`` from rollout probe lines; a version of None becomes null."""
    pattern = r"^(\S+) code=(\d+) api_version=(\S+)$"
    hit = lines.filter(F.col("value").rlike(pattern))
    version = F.regexp_extract("value", pattern, 3)
    return hit.select(
        F.regexp_extract("value", pattern, 1).alias("clock"),
        F.regexp_extract("value", pattern, 2).cast("int").alias("status"),
        F.when(version != "None", version).alias("api_version"),
    )


def write_if_valid(df: DataFrame, path: str, key: str | None = None) -> tuple[bool, DataFrame]:
    """Replace the committed table by ``df`` only when the contract holds, types included: whether it did, and the failures by check.

    Readers see the old rows until the new ones are all there; the same ``key`` is written once.
    """
    from wearlens.operators.validation import validate

    valid, failures = validate(df)
    if valid:
        committed.replace(df, path, key)
    return valid, failures


def append_rows(df: DataFrame, path: str, key: str | None = None) -> bool:
    """Append-only tables: runs, versions, alias events, decisions, drift summaries, metrics.

    A batch with the ``key`` of an earlier one adds nothing. ``committed.read`` reads them.
    """
    return committed.append(df, path, key)


def event_lines(df: DataFrame, event: str, level: str = "INFO", at: str = "ts") -> DataFrame:
    """One JSON log line per row, in the structured-log envelope."""
    body = [F.col(c) for c in df.columns if c != at]
    return df.select(
        F.to_json(
            F.struct(
                F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
                F.lit(level).alias("level"),
                F.lit(event).alias("event"),
                *body,
            ),
            {"ignoreNullFields": "false"},
        ).alias("value")
    )
