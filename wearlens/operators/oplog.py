"""Dashboards and load reports as queries over request logs and metric series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wearlens.functions.search import lower_bound
from wearlens.operators.ordered import ROWS_PER_SLICE, exact_quantiles, with_halo

SCRAPE_SECONDS = 15
STALE_SECONDS = 300

# fixed values: upper bounds of the latency histogram, milliseconds
LATENCY_BOUNDS = [5.0, 10.0, 25.0, 50.0, 75.0, 100.0, 250.0, 500.0, 750.0, 1000.0, 2500.0, 5000.0, 7500.0, 10000.0]


def window_start(at: str, every: str, slide: str | None = None) -> Column:
    """Start of the tumbling window, or of each sliding window, a row falls into."""
    return F.window(at, every, slide)["start"].alias("window_start")


def latency_quantiles(
    log: DataFrame, quantiles=(0.5, 0.95), path: str = "/predict", every: str = "5 minutes",
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """``window_start, q, quantile``: exact latency quantiles of one handler."""
    picked = log.filter(F.col("path") == path).select(window_start("ts", every), "duration_ms")
    return exact_quantiles(picked, ["window_start"], "duration_ms", list(quantiles), rows_per_slice)


def latency_buckets(log: DataFrame, path: str = "/predict", every: str = "5 minutes", bounds: list[float] = LATENCY_BOUNDS) -> DataFrame:
    """``window_start, le0.., total``: cumulative counts per bucket, which add up over parts of a log.

    One small row a window, combined before the shuffle; on a stream this row is all the state there is.
    """
    picked = log.filter(F.col("path") == path).groupBy(window_start("ts", every))
    return picked.agg(*[F.count_if(F.col("duration_ms") <= b).alias(f"le{i}") for i, b in enumerate(bounds)], F.count(F.lit(1)).alias("total"))


def histogram_quantiles(
    log: DataFrame, quantiles=(0.5, 0.95), path: str = "/predict", every: str = "5 minutes",
    bounds: list[float] = LATENCY_BOUNDS,
) -> DataFrame:
    return quantiles_of_buckets(latency_buckets(log, path, every, bounds), quantiles, bounds)


def quantiles_of_buckets(wide: DataFrame, quantiles=(0.5, 0.95), bounds: list[float] = LATENCY_BOUNDS) -> DataFrame:
    """``window_start, q, quantile`` interpolated in the buckets of ``latency_buckets``.

    Ranks beyond the last finite bound report that bound.
    """
    cells = F.array(
        *[
            F.struct(
                F.lit(bounds[i]).alias("hi"),
                F.lit(bounds[i - 1] if i else 0.0).alias("lo"),
                F.col(f"le{i}").alias("cum"),
                (F.col(f"le{i - 1}") if i else F.lit(0)).cast("long").alias("prev"),
            )
            for i in range(len(bounds))
        ]
    )
    asked = wide.withColumn("q", F.explode(F.array(*[F.lit(q) for q in quantiles])))
    rank = F.col("q") * F.col("total")
    hit = F.get(F.filter(cells, lambda c: (c["cum"] >= rank) & (c["cum"] > c["prev"])), F.lit(0))
    return asked.withColumn("__c", hit).select(
        "window_start",
        "q",
        F.coalesce(
            F.col("__c.lo")
            + (F.col("__c.hi") - F.col("__c.lo")) * (rank - F.col("__c.prev")) / (F.col("__c.cum") - F.col("__c.prev")),
            F.lit(bounds[-1]),
        ).alias("quantile"),
    )


def throughput(log: DataFrame, every: str = "1 minute", seconds: int = 60) -> DataFrame:
    """Requests per second by handler."""
    return (
        log.groupBy(window_start("ts", every), "path")
        .agg(F.count(F.lit(1)).alias("requests"))
        .withColumn("per_second", F.col("requests") / seconds)
    )


def error_rate(log: DataFrame, every: str = "5 minutes", slide: str | None = None) -> DataFrame:
    """Share of 5xx responses; with ``slide`` over the trailing window at every step."""
    failed = F.col("status_code") >= 500
    return log.groupBy(window_start("ts", every, slide)).agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(failed).alias("errors"),
        F.avg(failed.cast("double")).alias("error_rate"),
    )


def status_class() -> Column:
    return F.concat(F.floor(F.col("status_code") / 100).cast("string"), F.lit("xx")).alias("status")


def status_mix(log: DataFrame, every: str = "1 minute") -> DataFrame:
    return log.groupBy(window_start("ts", every), status_class()).agg(F.count(F.lit(1)).alias("requests"))


def latest_metric(series: DataFrame, by: list[str], order: list[str] = ("ts",)) -> DataFrame:
    """Last value of every series."""
    newest = F.struct(*order)
    return series.groupBy(*by).agg(F.max("ts").alias("ts"), F.max_by("value", newest).alias("value"))


def alert_state(
    series: DataFrame, by: list[str], as_of, threshold: float = 0.3, lookback_minutes: int = 10,
    order: list[str] = ("ts",), names: DataFrame | None = None,
) -> DataFrame:
    """ALERT when the last value in the lookback reaches the threshold, OK below, NoData without one.

    With ``names``, the table of all series, ``series`` need hold no more than the lookback.
    """
    if names is not None:
        series = names.select(*by).distinct().unionByName(series, allowMissingColumns=True)
    end = F.lit(as_of).cast("timestamp")
    recent = (F.col("ts") > end - F.make_dt_interval(mins=F.lit(lookback_minutes))) & (F.col("ts") <= end)
    last = F.max_by(F.when(recent, F.col("value")), F.when(recent, F.struct(*order)))
    return (
        series.groupBy(*by)
        .agg(last.alias("value"))
        .withColumn(
            "state",
            F.when(F.col("value").isNull(), "NoData").when(F.col("value") >= threshold, "ALERT").otherwise("OK"),
        )
    )


def series_gaps(
    series: DataFrame, by: list[str], id_col: str, scrape_seconds: int = SCRAPE_SECONDS,
    stale_seconds: int = STALE_SECONDS, rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Missed scrapes per series; ``hidden`` gaps are short enough for the last value to cover them."""
    order = ["ts", id_col]
    sliced = with_halo(series.select(*by, *order), by, order, 1, [], rows_per_slice)
    spec = Window.partitionBy(*by, "__slice").orderBy(*order)
    gap = (F.unix_micros("ts") - F.unix_micros("prev_ts")) / F.lit(1e6)
    return (
        sliced.withColumn("prev_ts", F.lag("ts").over(spec))
        .filter(~F.col("__halo"))
        .withColumn("gap_seconds", gap)
        .filter(F.col("gap_seconds") > scrape_seconds)
        .select(*by, "prev_ts", "ts", id_col, "gap_seconds", (F.col("gap_seconds") <= stale_seconds).alias("hidden"))
    )


def asof_fill(
    series: DataFrame, by: list[str], id_col: str, step_seconds: int = SCRAPE_SECONDS,
    stale_seconds: int = STALE_SECONDS, rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Every step a sample is current for: until the next sample, at most the staleness limit.

    A backward as-of join without the join: each sample emits its own few steps.
    """
    at = F.unix_micros("ts")
    keyed = series.select(*by, "ts", "value", (-at).alias("__neg_at"), (-F.col(id_col)).alias("__neg_id"))
    order = ["__neg_at", "__neg_id"]
    sliced = with_halo(keyed, by, order, 1, ["ts"], rows_per_slice)
    spec = Window.partitionBy(*by, "__slice").orderBy(*order)
    # in descending order the row before is the next sample
    follower = F.unix_micros(F.lag("ts").over(spec))
    step = F.lit(step_seconds * 1_000_000)
    first = F.ceil(at / step).cast("long")
    last = F.least(
        F.floor((at + stale_seconds * 1_000_000) / step).cast("long"),
        F.coalesce(F.ceil(F.col("__next") / step).cast("long") - 1, F.lit(1 << 62)),
    )
    return (
        sliced.withColumn("__next", follower)
        .filter(~F.col("__halo"))
        .withColumns({"__first": first, "__last": last})
        .filter(F.col("__first") <= F.col("__last"))
        .select(*by, F.explode(F.sequence("__first", "__last")).alias("__step"), "ts", "value")
        .select(*by, F.timestamp_micros(F.col("__step") * step).alias("step_ts"), F.col("ts").alias("sample_ts"), "value")
    )


def rejection_rate(checked: DataFrame, every: str = "1 hour") -> DataFrame:
    """Rejected requests per window and error type, as a share of all requests of the window."""
    start = window_start("ts", every)
    kinds = F.array_distinct(F.transform("errors", lambda e: e["type"]))
    flat = checked.select(start, F.explode(F.concat(F.array(F.lit("*")), kinds)).alias("error_type"))
    counts = flat.groupBy("window_start", "error_type").agg(F.count(F.lit(1)).alias("rejected"))
    total = F.max(F.when(F.col("error_type") == "*", F.col("rejected"))).over(Window.partitionBy("window_start"))
    return (
        counts.withColumn("requests", total)
        .filter(F.col("error_type") != "*")
        .withColumn("rate", F.col("rejected") / F.col("requests"))
    )


def latency_summary(
    log: DataFrame, quantiles=(0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99), rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """``item, value``: load-test figures and exact latency percentiles."""
    span = (F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))) / F.lit(1e6)
    totals = log.agg(
        F.count(F.lit(1)).cast("double").alias("requests"),
        span.alias("total_seconds"),
        F.max("duration_ms").alias("slowest"),
        F.min("duration_ms").alias("fastest"),
        F.avg("duration_ms").alias("average"),
        (F.count(F.lit(1)) / F.nullif(span, F.lit(0.0))).alias("requests_per_second"),
    )
    pairs = [F.struct(F.lit(c).alias("item"), F.col(c).alias("value")) for c in totals.columns]
    ranks = exact_quantiles(log, [], "duration_ms", list(quantiles), rows_per_slice)
    return totals.select(F.inline(F.array(*pairs))).unionByName(
        ranks.select(
            F.concat(F.lit("p"), F.round(F.col("q") * 100).cast("int").cast("string")).alias("item"),
            F.col("quantile").alias("value"),
        )
    )


def latency_histogram(log: DataFrame, bins: int = 10) -> DataFrame:
    """``bin, upper, requests``: equal bins from fastest to slowest; bin 0 holds the fastest value alone."""
    lo = log.agg(F.min("duration_ms")).scalar()
    hi = log.agg(F.max("duration_ms")).scalar()
    bound = lambda i: lo + (hi - lo) * F.lit(i / bins) if i < bins else hi
    edges = F.array(*[bound(i) for i in range(bins + 1)])
    counts = (
        log.select("duration_ms", edges.alias("__e"))
        .groupBy("__e", lower_bound(F.col("__e"), F.col("duration_ms"), bins + 1).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    each = counts.select("bin", "n", F.posexplode("__e").alias("i", "upper"))
    return each.groupBy(F.col("i").alias("bin"), "upper").agg(
        F.sum(F.when(F.col("bin") == F.col("i"), F.col("n")).otherwise(0)).alias("requests")
    )


def version_timeline(probes: DataFrame) -> DataFrame:
    """Per served version: first and last seen, probes, failures, and overlap with the version before."""
    seen = probes.groupBy("api_version").agg(
        F.min("ts").alias("first_seen"),
        F.max("ts").alias("last_seen"),
        F.count(F.lit(1)).alias("probes"),
        F.count_if(F.col("status") != 200).alias("failures"),
    )
    # one row per version that was ever rolled out
    order = Window.orderBy("first_seen", "api_version")
    overlap = (F.unix_micros(F.lag("last_seen").over(order)) - F.unix_micros("first_seen")) / F.lit(1e6)
    return seen.withColumn("overlap_seconds", F.greatest(F.lit(0.0), F.coalesce(overlap, F.lit(0.0))))


def version_changes(probes: DataFrame, id_col: str, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Probes whose version differs from that of the probe before."""
    order = ["ts", id_col]
    whole = probes.select(*order, "api_version").withColumn("__all", F.lit(0))
    sliced = with_halo(whole, ["__all"], order, 1, ["api_version"], rows_per_slice)
    spec = Window.partitionBy("__all", "__slice").orderBy(*order)
    changed = ~F.col("api_version").eqNullSafe(F.col("from_version"))
    return (
        sliced.withColumns({"from_version": F.lag("api_version").over(spec), "__first": F.lag("ts").over(spec)})
        .filter(~F.col("__halo") & F.col("__first").isNotNull() & changed)
        .select(id_col, "ts", "from_version", F.col("api_version").alias("to_version"))
    )


def reconcile(left: DataFrame, right: DataFrame, marker: str) -> DataFrame:
    """``marker, status`` for invocations that only one of two logs recorded."""
    a = left.select(marker).distinct().withColumn("__a", F.lit(True))
    b = right.select(marker).distinct().withColumn("__b", F.lit(True))
    return (
        a.join(b, marker, "full")
        .filter(F.col("__a").isNull() | F.col("__b").isNull())
        .select(marker, F.when(F.col("__b").isNull(), "missing_in_right").otherwise("missing_in_left").alias("status"))
    )


def paired_scores(df: DataFrame, id_col: str, scenarios: dict[str, dict[str, Column]], score) -> DataFrame:
    """Score every entity under every scenario, side by side in its own row: no shuffle, one scan.

    ``scenarios`` maps a name to the columns it changes; ``score`` adds ``score`` to a frame.
    """
    original = [c for c in df.columns if c != id_col]
    out, done = df, []
    for name, changes in scenarios.items():
        kept = out.withColumn("__kept", F.struct(*original))
        scored = score(kept.withColumns(changes))
        out = scored.select(id_col, "__kept.*", *done, F.col("score").alias(f"score_{name}"))
        done.append(f"score_{name}")
    return out.select(id_col, *done)
