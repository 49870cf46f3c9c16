"""Cleaning with full accounting: every dropped row is attributed to the step that dropped it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from wearlens.contract import (
    MACHINE_TYPES, REQUIRED_READING, SENSOR_RANGES, SERVICE_AT, TIMESTAMP_NAMES, URGENT_AT, in_range,
    require_columns,
)


def absent(df: DataFrame, column: str) -> Column:
    """Null, or NaN in a floating column."""
    gone = F.col(column).isNull()
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        gone = gone | F.isnan(column)
    return gone


def any_of(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for cond in conditions:
        out = out | cond
    return out


def out_of_range(column: str, lo: float, hi: float) -> Column:
    """True also for a missing value: it is not inside the range."""
    return ~F.coalesce(in_range(column, lo, hi), F.lit(False))


def timestamp_column(df: DataFrame) -> str | None:
    return next((c for c in TIMESTAMP_NAMES if c in df.columns), None)


def bad_timestamp(df: DataFrame) -> Column:
    name = timestamp_column(df)
    if name is None or not isinstance(df.schema[name].dataType, T.StringType):
        return F.lit(False)
    return F.col(name).isNotNull() & F.try_to_timestamp(name).isNull()


def drop_missing(df: DataFrame, required=REQUIRED_READING) -> DataFrame:
    require_columns(df, required)
    return df.filter(~any_of([absent(df, c) for c in required]))


def null_counts(df: DataFrame, required=REQUIRED_READING) -> DataFrame:
    """``column, nulls`` for the required columns that have any."""
    counts = df.agg(*[F.count_if(absent(df, c)).alias(c) for c in required])
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in required]
    return counts.select(F.inline(F.array(*pairs))).filter("nulls > 0")


def drop_bad_timestamps(df: DataFrame) -> DataFrame:
    """Drop unparseable timestamps, keep null ones, replace text by parsed values."""
    name = timestamp_column(df)
    if name is None or not isinstance(df.schema[name].dataType, T.StringType):
        return df
    return df.filter(~bad_timestamp(df)).withColumn(name, F.try_to_timestamp(name))


def drop_outliers(df: DataFrame, ranges=SENSOR_RANGES) -> DataFrame:
    return df.filter(~any_of([out_of_range(c, *r) for c, r in ranges.items()]))


def outlier_counts(df: DataFrame, ranges=SENSOR_RANGES) -> DataFrame:
    """``column, rows``: per column with overlaps, and their union under ``any``."""
    tests = {c: out_of_range(c, *r) for c, r in ranges.items()}
    tests["any"] = any_of(list(tests.values()))
    counts = df.agg(*[F.count_if(t).alias(c) for c, t in tests.items()])
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("rows")) for c in tests]
    return counts.select(F.inline(F.array(*pairs)))


def with_first_fault(df: DataFrame, required=REQUIRED_READING, ranges=SENSOR_RANGES) -> DataFrame:
    """Add ``first_fault``: the step that drops the row, null for a row that stays."""
    missing = any_of([absent(df, c) for c in required])
    outlier = any_of([out_of_range(c, *r) for c, r in ranges.items()])
    return df.withColumn(
        "first_fault",
        F.when(missing, "missing").when(bad_timestamp(df), "bad_timestamp").when(outlier, "out_of_range"),
    )


def clean(df: DataFrame, required=REQUIRED_READING, ranges=SENSOR_RANGES) -> DataFrame:
    """All three steps as one scan: the rows ``with_first_fault`` marks with null.

    Written as plain conjuncts, which prune row groups and stay small after pushdown. A range test
    fails on null and NaN by itself.
    """
    require_columns(df, required)
    kept = df
    for c, r in ranges.items():
        kept = kept.filter(in_range(c, *r))
    for c in required:
        if c not in ranges:
            kept = kept.filter(~absent(df, c))
    name = timestamp_column(df)
    if name is not None and isinstance(df.schema[name].dataType, T.StringType):
        kept = kept.filter(F.col(name).isNull() | F.try_to_timestamp(name).isNotNull())
        kept = kept.withColumn(name, F.try_to_timestamp(name))
    return kept


def clean_report(df: DataFrame, required=REQUIRED_READING, ranges=SENSOR_RANGES) -> DataFrame:
    """The whole accounting as one nested row, from a single aggregate over one scan."""
    name = timestamp_column(df)
    fault = with_first_fault(df, required, ranges)
    reached_outliers = F.coalesce(F.col("first_fault") == "out_of_range", F.col("first_fault").isNull())
    counts = fault.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(F.col("first_fault") == "missing").alias("missing"),
        F.count_if(F.col("first_fault") == "bad_timestamp").alias("bad_timestamp"),
        F.count_if(F.col("first_fault") == "out_of_range").alias("out_of_range"),
        *[F.count_if(absent(df, c)).alias(f"null_{c}") for c in required],
        *[F.count_if(reached_outliers & out_of_range(c, *r)).alias(f"out_{c}") for c, r in ranges.items()],
    )
    nulls = F.map_filter(
        F.create_map(*[x for c in required for x in (F.lit(c), F.col(f"null_{c}"))]), lambda _, n: n > 0
    )
    after_missing = F.col("rows_in") - F.col("missing")
    after_stamps = after_missing - F.col("bad_timestamp")
    rows_out = after_stamps - F.col("out_of_range")
    return counts.select(
        "rows_in",
        F.struct(
            F.col("rows_in").alias("rows_before"),
            F.col("missing").alias("rows_dropped_missing"),
            nulls.alias("null_counts_by_column"),
        ).alias("missing_values"),
        F.struct(
            F.lit(name).alias("timestamp_column"),
            after_missing.alias("rows_before"),
            F.col("bad_timestamp").alias("rows_dropped_bad_timestamp"),
        ).alias("timestamps"),
        F.struct(
            after_stamps.alias("rows_before"),
            F.col("out_of_range").alias("rows_dropped_outliers"),
            F.create_map(*[x for c in ranges for x in (F.lit(c), F.col(f"out_{c}"))]).alias("out_of_range_by_column"),
        ).alias("outliers"),
        rows_out.alias("rows_out"),
        (F.col("rows_in") - rows_out).alias("rows_dropped_total"),
    )


def clean_report_items(report: DataFrame) -> DataFrame:
    """The nested report as ``item, rows``."""
    flat = [
        ("rows_in", "rows_in"),
        ("dropped_missing", "missing_values.rows_dropped_missing"),
        ("dropped_bad_timestamp", "timestamps.rows_dropped_bad_timestamp"),
        ("dropped_outliers", "outliers.rows_dropped_outliers"),
        ("rows_out", "rows_out"),
        ("dropped_total", "rows_dropped_total"),
    ]
    totals = F.create_map(*[x for item, path in flat for x in (F.lit(item), F.col(path))])

    def prefixed(path: str, prefix: str) -> Column:
        return F.transform_keys(path, lambda k, _: F.concat(F.lit(prefix), k))

    items = F.map_concat(
        totals,
        prefixed("missing_values.null_counts_by_column", "null:"),
        prefixed("outliers.out_of_range_by_column", "range:"),
    )
    return report.select(F.explode(items).alias("item", "rows"))


def quarantine(df: DataFrame, required=REQUIRED_READING, ranges=SENSOR_RANGES) -> DataFrame:
    """Faulty rows with every reason that applies, not only the first."""
    reasons = [F.when(absent(df, c), f"missing:{c}") for c in required]
    reasons += [F.when(bad_timestamp(df), "bad_timestamp")]
    reasons += [
        F.when(~absent(df, c) & out_of_range(c, *r), f"out_of_range:{c}") for c, r in ranges.items()
    ]
    reasons += [F.when(~F.col("type").isin(MACHINE_TYPES), "bad_category:type")]
    found = F.filter(F.array(*reasons), lambda r: r.isNotNull())
    return df.withColumn("reasons", found).filter(F.size("reasons") > 0)


def action_tier(probability: str, urgent: float = URGENT_AT, service: float = SERVICE_AT) -> Column:
    """The tier of a probability; null for a missing one."""
    p = F.col(probability)
    known = F.when(p >= urgent, "urgent_alert").when(p >= service, "schedule_service").otherwise("monitor")
    return F.when(p.isNotNull() & ~F.isnan(p), known)
