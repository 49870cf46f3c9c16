"""Distribution drift of a current window against a reference, per column and overall."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wearlens.contract import COLUMN_DRIFT_AT, DATASET_DRIFT_AT, SENSORS
from wearlens.functions.search import lower_bound, portable_uniform
from wearlens.operators.ordered import ROWS_PER_SLICE, exact_quantiles, running_totals, slice_limit
from wearlens.operators.profiling import unpivot_numeric

NUMERIC = [*SENSORS, "prediction"]
CATEGORICAL = ["type"]
STD_FLOOR = 1e-3
PSI_BINS = 10
PSI_FLOOR = 1e-4
MIN_ROWS = 100

# fixed values: the cold-weather scenario's uniform ranges, inside the contract
COLD_SHIFT = {"air_temperature_k": (282.0, 289.0), "process_temperature_k": (288.0, 296.0)}


def _sides(reference: DataFrame, current: DataFrame, unpivot, groups: list[str]) -> DataFrame:
    """``groups, column, value, ref, cur``: rows per distinct value on each side."""
    ref = unpivot(reference).withColumns({"__r": F.lit(1), "__c": F.lit(0)})
    cur = unpivot(current).withColumns({"__r": F.lit(0), "__c": F.lit(1)})
    return (
        ref.unionByName(cur)
        .filter(F.col("value").isNotNull())
        .groupBy(*groups, "column", "value")
        .agg(F.sum("__r").alias("ref"), F.sum("__c").alias("cur"))
    )


def _categories(df: DataFrame, columns: list[str], groups: list[str]) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    return df.select(*groups, F.inline(F.array(*pairs)))


def kolmogorov_p(d: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sample p-value; the series is 1 to working precision below 0.2."""
    lam = d * F.sqrt(F.try_divide(n.cast("double") * m, n + m))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda a, k: a + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * lam * lam),
    )
    return F.when(lam < 0.2, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))


def numeric_drift(
    reference: DataFrame, current: DataFrame, columns=NUMERIC, groups: list[str] = (),
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Normalized Wasserstein distance and the K-S statistic of every column in one job.

    Both come from the two cumulative shares over the merged value axis. With ``groups`` both
    sides carry those columns and each group is compared on its own.
    """
    groups = list(groups)
    counts = _sides(reference, current, lambda d: unpivot_numeric(d, columns, groups), groups)
    # every column has at most the rows of its group: count those instead of the distinct values
    rows = reference.select(*groups, F.lit(0).alias("__all")).unionByName(current.select(*groups, F.lit(0).alias("__all")))
    return _numeric_scores(counts, groups, slice_limit(rows, [*groups, "__all"], rows_per_slice, copies=len(columns)))


def _numeric_scores(counts: DataFrame, groups: list[str], limit: float | None) -> DataFrame:
    counts = counts.withColumn("__weighted", F.col("value") * F.col("ref"))
    run = running_totals(counts, [*groups, "column"], "value", ["ref", "cur", "__weighted"], limit=limit)
    # a side without values has no share: the scores are null
    gap = F.abs(F.try_divide("ref_cum", "ref_total") - F.try_divide("cur_cum", "cur_total"))
    from_mean = F.col("value") - F.try_divide("__weighted_total", "ref_total")
    scores = run.groupBy(*groups, "column").agg(
        F.sum(gap * F.coalesce(F.col("value_next") - F.col("value"), F.lit(0.0))).alias("w1"),
        F.max(gap).alias("ks"),
        F.sum(F.col("ref") * from_mean * from_mean).alias("squares"),
        F.max("ref_total").alias("ref_rows"),
        F.max("cur_total").alias("cur_rows"),
    )
    std = F.sqrt(F.try_divide("squares", "ref_rows"))  # population deviation of the reference
    return scores.select(
        *groups,
        "column",
        (F.col("w1") / F.greatest(std, F.lit(STD_FLOOR))).alias("wasserstein"),
        "ks",
        F.when(F.col("ks").isNotNull(), kolmogorov_p(F.col("ks"), F.col("ref_rows"), F.col("cur_rows"))).alias("ks_p"),
        "ref_rows",
        "cur_rows",
    )


def categorical_drift(
    reference: DataFrame, current: DataFrame, columns=CATEGORICAL, groups: list[str] = ()
) -> DataFrame:
    """Jensen-Shannon distance, natural logarithm."""
    groups = list(groups)
    return _categorical_scores(_sides(reference, current, lambda d: _categories(d, columns, groups), groups), groups)


def _categorical_scores(counts: DataFrame, groups: list[str]) -> DataFrame:
    keys = [*groups, "column"]
    totals = counts.groupBy(*keys).agg(F.sum("ref").alias("ref_rows"), F.sum("cur").alias("cur_rows"))
    p, q = F.try_divide("ref", "ref_rows"), F.try_divide("cur", "cur_rows")
    mid = (p + q) / 2

    def part(x):
        return F.when(x > 0, x * F.log(x / mid)).otherwise(0.0)

    both = (F.col("ref_rows") > 0) & (F.col("cur_rows") > 0)
    return (
        counts.join(totals, keys)
        .groupBy(*keys, "ref_rows", "cur_rows")
        .agg(F.sqrt(F.greatest(F.sum((part(p) + part(q)) / 2), F.lit(0.0))).alias("js"))
        .withColumn("js", F.when(both, F.col("js")))
        .select(*keys, "js", "ref_rows", "cur_rows")
    )


def psi(
    reference: DataFrame, current: DataFrame, columns=NUMERIC, bins: int = PSI_BINS,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Population stability index over bins cut at the reference quantiles."""
    counts = _sides(reference, current, lambda d: unpivot_numeric(d, columns), [])
    ref_long = unpivot_numeric(reference, columns)
    cuts = exact_quantiles(ref_long, ["column"], "value", [i / bins for i in range(1, bins)], rows_per_slice)
    edges = cuts.groupBy("column").agg(F.array_sort(F.collect_set("quantile")).alias("__edges"))
    binned = (
        counts.join(F.broadcast(edges), "column")  # bins - 1 numbers per column
        .withColumn("__bin", lower_bound(F.col("__edges"), F.col("value"), bins))
        .groupBy("column", "__bin")
        .agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))
    )
    totals = binned.groupBy("column").agg(F.sum("ref").alias("ref_rows"), F.sum("cur").alias("cur_rows"))
    p = F.greatest(F.col("ref") / F.col("ref_rows"), F.lit(PSI_FLOOR))
    q = F.greatest(F.col("cur") / F.col("cur_rows"), F.lit(PSI_FLOOR))
    return (
        binned.join(totals.filter("ref_rows > 0 and cur_rows > 0"), "column")
        .groupBy("column")
        .agg(F.sum((p - q) * F.log(p / q)).alias("psi"))
    )


def drift_by_column(
    reference: DataFrame, current: DataFrame, numeric=NUMERIC, categorical=CATEGORICAL,
    groups: list[str] = (), threshold: float = COLUMN_DRIFT_AT, rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """``groups, column, method, score, drifted, reason`` with both window sizes.

    Every column asked for has a row in every group of the reference. One that has values on one
    side only has no score; it is drifted, and the reason says which side is empty.
    """
    groups = list(groups)
    num = numeric_drift(reference, current, numeric, groups, rows_per_slice)
    cat = categorical_drift(reference, current, categorical, groups)
    base = reference.select(*groups).distinct() if groups else reference.sparkSession.range(1).select()
    return _decided(num, cat, base, numeric, categorical, groups, threshold)


def value_counts(df: DataFrame, numeric=NUMERIC, categorical=CATEGORICAL, groups: list[str] = ()) -> DataFrame:
    """``groups, column, value, category, rows``: all that drift needs of a window. Counts of parts add up."""
    none = F.lit(None)
    num = unpivot_numeric(df, numeric, list(groups)).withColumn("category", none.cast("string"))
    cat = _categories(df, categorical, list(groups)).select(*groups, "column", none.cast("double").alias("value"), F.col("value").alias("category"))
    return added(num.unionByName(cat).filter("value is not null or category is not null").withColumn("rows", F.lit(1).cast("long")), groups)


def added(counts: DataFrame, groups: list[str] = ()) -> DataFrame:
    return counts.groupBy(*groups, "column", "value", "category").agg(F.sum("rows").alias("rows"))


def drift_of_counts(
    reference: DataFrame, current: DataFrame, numeric=NUMERIC, categorical=CATEGORICAL,
    threshold: float = COLUMN_DRIFT_AT, rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """``drift_by_column`` from the ``value_counts`` of both sides."""
    zero = F.lit(0).cast("long")
    both = reference.select("*", F.col("rows").alias("ref"), zero.alias("cur")).unionByName(current.select("*", zero.alias("ref"), F.col("rows").alias("cur")))
    both = both.groupBy("column", "value", "category").agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))
    counts = both.filter("value is not null").drop("category")
    num = _numeric_scores(counts, [], slice_limit(counts, ["column"], rows_per_slice))
    cat = _categorical_scores(both.filter("value is null").drop("value"), [])
    return _decided(num, cat, reference.sparkSession.range(1).select(), numeric, categorical, [], threshold)


def _decided(num: DataFrame, cat: DataFrame, base: DataFrame, numeric, categorical, groups: list[str], threshold: float) -> DataFrame:
    methods = {**{c: "normalized_wasserstein" for c in numeric}, **{c: "jensen_shannon" for c in categorical}}
    asked = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(m).alias("method")) for c, m in methods.items()]))
    num = num.select(
        *groups, "column", F.lit("normalized_wasserstein").alias("method"), F.col("wasserstein").alias("score"),
        "ref_rows", "cur_rows",
    )
    cat = cat.select(
        *groups, "column", F.lit("jensen_shannon").alias("method"), F.col("js").alias("score"), "ref_rows", "cur_rows"
    )
    scored = base.select(*groups, asked).join(num.unionByName(cat), [*groups, "column", "method"], "left")
    zero = F.lit(0).cast("long")
    ref_rows, cur_rows = F.coalesce("ref_rows", zero), F.coalesce("cur_rows", zero)
    reason = F.when(F.col("score").isNotNull(), None).when(cur_rows > 0, "no_reference_values").when(ref_rows > 0, "no_current_values").otherwise("no_values")
    drifted = F.coalesce(F.col("score") >= threshold, (ref_rows > 0) | (cur_rows > 0))
    return scored.select(
        *groups, "column", "method", "score", ref_rows.alias("ref_rows"), cur_rows.alias("cur_rows"), drifted.alias("drifted"), reason.alias("reason")
    )


def summarize(
    by_column: DataFrame, groups: list[str] = (), threshold: float = DATASET_DRIFT_AT, min_rows: int = MIN_ROWS
) -> DataFrame:
    """Share of drifted columns and the decision; small windows are marked, not hidden.

    An empty current window has no score and the status ``no_current_rows``.
    """
    share = F.try_divide("drifted_column_count", "total_columns")
    filled = F.col("current_window_size") > 0
    out = by_column.groupBy(*groups).agg(
        F.count_if("drifted").alias("__drifted"),
        F.count(F.lit(1)).alias("total_columns"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("column", "score")))).alias("per_column_drift"),
        F.max("ref_rows").alias("reference_window_size"),
        F.coalesce(F.max("cur_rows"), F.lit(0)).alias("current_window_size"),
    )
    out = out.withColumn("drifted_column_count", F.when(filled, F.col("__drifted")).otherwise(0))
    scored = F.when(filled, share)
    return out.select(
        *groups,
        scored.alias("drift_score"),
        "drifted_column_count",
        "total_columns",
        F.coalesce(scored >= threshold, F.lit(False)).alias("drift_detected"),
        F.lit(threshold).alias("threshold"),
        "reference_window_size",
        "current_window_size",
        (F.col("current_window_size") >= min_rows).alias("min_rows_ok"),
        F.when(filled, "ok").otherwise("no_current_rows").alias("status"),
        "per_column_drift",
    )


def drift_summary(reference: DataFrame, current: DataFrame, **options) -> DataFrame:
    return summarize(drift_by_column(reference, current, **options))


def drift_by_window(
    reference: DataFrame, current: DataFrame, minutes: list[int], as_of, at: str = "ts", **options
) -> DataFrame:
    """The summary for several lookbacks from ``as_of`` in one job; each row enters every window it is in."""
    all_windows = F.array(*[F.lit(m) for m in sorted(minutes)])
    end = F.lit(as_of).cast("timestamp")
    age = (F.unix_micros(end) - F.unix_micros(at)) / F.lit(60e6)
    inside = F.filter(all_windows, lambda m: (age <= m) & (age >= 0))
    cur = current.withColumn("window_minutes", F.explode(inside))
    ref = reference.withColumn("window_minutes", F.explode(all_windows))
    by_column = drift_by_column(ref, cur, groups=["window_minutes"], **options)
    return summarize(by_column, ["window_minutes"])


def cold_shift(df: DataFrame, id_col: str = "unit_id", seed: int = 7, ranges=COLD_SHIFT) -> DataFrame:
    """Replace both temperatures by uniforms of the cold scenario, reproducible by id."""
    return df.withColumns({c: portable_uniform(id_col, seed + i, *r) for i, (c, r) in enumerate(ranges.items())})


def summary_metrics(summary: DataFrame, at: str) -> DataFrame:
    """``name, ts, value``: the gauges of one drift run, all from the same summary row."""
    stamp = F.lit(at).cast("timestamp")
    gauges = {
        "drift_score": F.col("drift_score"),
        "drift_detected": F.col("drift_detected").cast("double"),
        "drift_current_window_size": F.col("current_window_size").cast("double"),
        "drift_last_run_timestamp": F.unix_timestamp(stamp).cast("double"),
    }
    return summary.select(
        F.inline(F.array(*[F.struct(F.lit(n).alias("name"), stamp.alias("ts"), v.alias("value")) for n, v in gauges.items()]))
    )


def next_step(summary: DataFrame) -> str:
    """``retrain`` or ``skip``; raises when the run had nothing to compare."""
    row = summary.select("drift_detected", "status").first()
    if row["status"] != "ok":
        raise ValueError("no current rows to compare")
    return "retrain" if row["drift_detected"] else "skip"
