"""Keyed rolling features and the audits of how they go wrong."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wearlens.contract import DEFAULT_WINDOWS, SENSORS, feature_names, require_columns
from wearlens.functions.readings import window_features
from wearlens.operators.ordered import ROWS_PER_SLICE, with_halo

# wear ties heavily, so the unique reading id completes the order
STREAM_KEY = ["type"]
STREAM_ORDER = ["tool_wear_min", "unit_id"]


def feature_columns(spec, sensors, windows, which=("rollmean", "rollstd", "roc")) -> dict[str, Column]:
    """The feature expressions over one window partitioning and order."""
    out = {}
    for c in sensors:
        x = F.col(c).cast("double")
        for w in windows:
            frame = spec.rowsBetween(1 - w, 0)
            if "rollmean" in which:
                out[f"{c}_rollmean_w{w}"] = F.avg(x).over(frame)
            if "rollstd" in which:
                # one reading has no spread: 0, not null
                out[f"{c}_rollstd_w{w}"] = F.coalesce(F.stddev_samp(x).over(frame), F.lit(0.0))
        if "roc" in which:
            out[f"{c}_roc"] = x - F.coalesce(F.lag(x).over(spec), x)
    return out


def rolling_features(
    df: DataFrame,
    keys: list[str] = STREAM_KEY,
    order: list[str] = STREAM_ORDER,
    sensors: list[str] = SENSORS,
    windows=DEFAULT_WINDOWS,
    which=("rollmean", "rollstd", "roc"),
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Mean, sample std and rate of change of the last readings per key, the current one included.

    All expressions share one partitioning and order: one shuffle and one sort. A key that holds
    too many rows for one task is sliced along its order, see ``wearlens.operators.ordered``.
    """
    require_columns(df, [*keys, *order, *sensors])
    sliced = with_halo(df, keys, order, max(max(windows) - 1, 1), sensors, rows_per_slice)
    spec = Window.partitionBy(*keys, "__slice").orderBy(*order)
    return (
        sliced.withColumns(feature_columns(spec, sensors, windows, which))
        .filter(~F.col("__halo"))
        .drop("__slice", "__halo")
    )


def stream_prefix(df: DataFrame, n: int, keys=STREAM_KEY, order=STREAM_ORDER) -> DataFrame:
    """The first ``n`` readings of every key with their 1-based ``position``.

    The rank limit is applied before the shuffle too, so a hot key sends ``n`` rows per task.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("position", F.row_number().over(first)).filter(F.col("position") <= n)


def _diverged(left: str, right: str, tolerance: float) -> Column:
    return F.coalesce(F.abs(F.col(left) - F.col(right)) > tolerance, F.lit(True))


def feature_parity(
    df: DataFrame, upto: int = 37, keys=STREAM_KEY, order=STREAM_ORDER, sensors=SENSORS,
    windows=DEFAULT_WINDOWS, tolerance: float = 1e-9, rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Batch features of reading ``upto`` of each key, or its last if it has fewer, against a replay.

    The replay runs the request path over an array of at most ``upto`` readings.
    """
    names = feature_names(sensors, windows)
    prefix = stream_prefix(df, upto, keys, order)
    replay = window_features(
        prefix.groupBy(*keys)
        .agg(
            F.array_sort(F.collect_list(F.struct("position", F.struct(*sensors).alias("r")))).alias("__h"),
            F.max_by("unit_id", "position").alias("unit_id"),
        )
        .withColumn("__h", F.transform("__h", lambda h: h["r"])),
        "__h", sensors, windows,
    ).select("unit_id", *[F.col(n).alias(f"__l_{n}") for n in names])
    batch = rolling_features(df, keys, order, sensors, windows, rows_per_slice=rows_per_slice)
    mismatches = sum((_diverged(n, f"__l_{n}", tolerance).cast("int") for n in names), F.lit(0))
    return batch.join(replay, "unit_id").select(
        *keys, "unit_id", F.lit(len(names)).alias("features_checked"), mismatches.alias("mismatches")
    )


def cold_start_skew(
    df: DataFrame, upto: int = 5, keys=STREAM_KEY, order=STREAM_ORDER, sensors=SENSORS,
    windows=DEFAULT_WINDOWS, tolerance: float = 1e-9,
) -> DataFrame:
    """How many features would differ had the buffer started empty at each of the first readings."""
    names = feature_names(sensors, windows)
    prefix = stream_prefix(df, upto, keys, order)
    spec = Window.partitionBy(*keys).orderBy("position")
    warm = prefix.withColumns(feature_columns(spec, sensors, windows))

    def cold(name):
        if "_rollmean_w" in name:
            return F.col(name.split("_rollmean_w")[0]).cast("double")
        return F.lit(0.0)

    apart = sum(((F.abs(F.col(n) - cold(n)) > tolerance).cast("int") for n in names), F.lit(0))
    return warm.select(
        *keys, "position", "unit_id", F.lit(len(names)).alias("features"), apart.alias("diverged")
    )


def boundary_leak(
    df: DataFrame, sensor: str = "torque_nm", window: int = 5, keys=STREAM_KEY, order=STREAM_ORDER,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Rolling mean with and without the key, where they can differ: the first rows of each key.

    Only ``window - 1`` rows on both sides of each boundary are needed, so the un-keyed window
    runs on those alone.
    """
    reach = window - 1
    first = Window.partitionBy(*keys).orderBy(*order)
    last = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    needed = df.select(*keys, *order, sensor)
    head = needed.withColumn("__r", F.row_number().over(first)).filter(F.col("__r") <= reach).drop("__r")
    tail = needed.withColumn("__r", F.row_number().over(last)).filter(F.col("__r") <= reach).drop("__r")
    edges = head.withColumn("__head", F.lit(True)).unionByName(
        tail.join(head.select(order[-1]), order[-1], "left_anti").withColumn("__head", F.lit(False))
    )
    edges = edges.withColumn("__all", F.lit(0))
    sliced = with_halo(edges, ["__all"], [*keys, *order], reach, [sensor], rows_per_slice)
    unkeyed = Window.partitionBy("__all", "__slice").orderBy(*keys, *order).rowsBetween(-reach, 0)
    keyed = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-reach, 0)
    x = F.col(sensor).cast("double")
    return (
        sliced.withColumn("unkeyed_mean", F.avg(x).over(unkeyed))
        .filter(~F.col("__halo") & F.col("__head"))
        .withColumn("keyed_mean", F.avg(x).over(keyed))
        .select(*keys, order[-1], "keyed_mean", "unkeyed_mean", (F.col("unkeyed_mean") - F.col("keyed_mean")).alias("leak"))
    )
