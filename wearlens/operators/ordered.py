"""Order-dependent work without one-task sorts.

A window over a key that holds a third of the table would sort that third in one task. Here a
hot key is cut into consecutive *slices* of its own order, so every slice is an ordinary window
partition. What a slice needs from its neighbours is small and is supplied separately: the last
few rows before it (``with_halo``) or the totals of everything before it (``running_totals``).

Slices depend on row values alone, so a retried or re-planned task reproduces them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from wearlens.functions.search import lower_bound

# A key is cut when it holds more than max(rows_per_slice, total / MAX_HOT_KEYS) rows. At most
# MAX_HOT_KEYS keys can do so, and their slices number at most 2 * MAX_HOT_KEYS together, which
# is what bounds every frame broadcast below whatever the size of the table.
MAX_HOT_KEYS = 16_384
ROWS_PER_SLICE = 250_000
SAMPLES_PER_SLICE = 16
ONE_LEVEL = 64  # cut points of a key up to which one search is used


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _join_small(df: DataFrame, small: DataFrame, keys: list[str], extra: list[str] = ()) -> DataFrame:
    """Null-safe left join with a frame of proven size."""
    on = [*keys, *extra]
    small = small.withColumnsRenamed({k: f"__r_{k}" for k in on})
    cond = F.lit(True)
    for k in on:
        cond = cond & _same(k, f"__r_{k}")
    return df.join(F.broadcast(small), cond, "left").drop(*[f"__r_{k}" for k in on])


def _key_columns(df: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    return (df, list(keys)) if keys else (df.withColumn("__all", F.lit(0)), ["__all"])


def _limit(total: int, rows_per_slice: int, copies: int) -> float:
    return max(float(rows_per_slice), total * copies / MAX_HOT_KEYS)


def _key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))


def slice_limit(df: DataFrame, keys: list[str], rows_per_slice: int, copies: int = 1) -> float | None:
    """Rows a key may hold before it is cut, or None when no key holds that many.

    Runs one aggregate over the key columns and fetches a single row, so that tables without hot
    keys, the usual case, keep the plain one-shuffle plan. ``copies`` says how many keys of the
    frame to be cut stand for each key of ``df``.
    """
    size = _key_counts(df, keys).agg(F.sum("__n").alias("total"), F.max("__n").alias("largest")).first()
    if not size["total"]:
        return None
    limit = _limit(size["total"], rows_per_slice, copies)
    return limit if size["largest"] > limit else None


def hot_keys(df: DataFrame, keys: list[str], limit: float) -> DataFrame | None:
    """Keys to cut and the number of slices each gets, as a local frame: fewer than MAX_HOT_KEYS rows."""
    found = _key_counts(df, keys).filter(F.col("__n") > limit)
    found = found.withColumn("__slices", F.ceil(F.col("__n") / limit).cast("int"))
    rows = found.collect()
    return df.sparkSession.createDataFrame(rows, found.schema) if rows else None


def slice_bounds(df: DataFrame, keys: list[str], order: list[str], limit: float) -> tuple[DataFrame, int] | None:
    """Per hot key the ascending (order) tuples that start its slices, and the most any key has.

    The cut points come from a hash sample of about SAMPLES_PER_SLICE distinct tuples per slice.
    They steer balance only; any cut points give the same results. They are fetched, at most
    2 * MAX_HOT_KEYS of them in all, so that every use of the plan sees the same ones.
    """
    hot = hot_keys(df, keys, limit)
    if hot is None:
        return None
    picked = _join_small(df.select(*keys, *order), hot, keys).filter(
        F.pmod(F.xxhash64(*order), F.lit(1 << 31)).cast("double") * F.col("__n")
        < F.col("__slices") * F.lit(SAMPLES_PER_SLICE) * F.lit(float(1 << 31))
    )
    sampled = (
        picked.select(*keys, "__slices", F.struct(*order).alias("__at"))
        .distinct()
        .groupBy(*keys, "__slices")
        .agg(F.array_sort(F.collect_list("__at")).alias("__sample"))
    )
    step = F.size("__sample") / F.col("__slices")
    bounds = sampled.select(
        *keys,
        F.array_distinct(
            F.transform(
                F.filter(F.sequence(F.lit(1), F.col("__slices")), lambda i: i < F.col("__slices")),
                lambda i: F.get("__sample", F.floor(i * step).cast("int")),
            )
        ).alias("__bounds"),
    )
    rows = bounds.collect()
    if not rows:
        return None
    return df.sparkSession.createDataFrame(rows, bounds.schema), max(len(r["__bounds"]) for r in rows)


def with_slices(df: DataFrame, keys: list[str], order: list[str], limit: float) -> DataFrame:
    """Add ``__slice``: 0.. along the order inside a hot key, null for a key left whole."""
    found = slice_bounds(df, keys, order, limit)
    if found is None:
        return df.withColumn("__slice", F.lit(None).cast("int"))
    bounds, most = found
    at = F.struct(*order)
    if most <= ONE_LEVEL:
        one = _join_small(df, bounds, keys)
        slice_ = F.when(F.col("__bounds").isNotNull(), lower_bound(F.col("__bounds"), at, most))
        return one.withColumn("__slice", slice_).drop("__bounds")
    # two searches in about sqrt(most) cut points each: a row never carries all of its key's
    step = math.isqrt(most - 1) + 1
    coarse = F.transform(F.sequence(F.lit(0), F.size("__bounds") - 1, F.lit(step)), lambda i: F.get("__bounds", i))
    blocks = F.posexplode(F.transform(F.sequence(F.lit(0), F.size("__bounds") - 1, F.lit(step)), lambda i: F.slice("__bounds", i + 1, step)))
    fine = bounds.select(*keys, blocks.alias("__block", "__fine"))
    first = _join_small(df, bounds.select(*keys, coarse.alias("__coarse")), keys)
    first = first.withColumn("__hot", F.col("__coarse").isNotNull())
    first = first.withColumn("__block", lower_bound(F.col("__coarse"), at, step) - 1).drop("__coarse")
    both = _join_small(first, fine, keys, ["__block"])
    inside = F.when(F.col("__block") < 0, 0).otherwise(F.col("__block") * step + lower_bound(F.col("__fine"), at, step))
    return both.withColumn("__slice", F.when(F.col("__hot"), inside.cast("int"))).drop("__hot", "__block", "__fine")


def with_halo(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    lookback: int,
    carry: list[str],
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Slice ``df`` and copy to each slice the ``lookback`` rows that precede it.

    Copies have ``__halo`` = true, hold the ``carry`` columns and null elsewhere. Windows over ``Window.partitionBy(*keys, "__slice")`` that
    reach back at most ``lookback`` rows are then exact on the rows where ``__halo`` is false.
    The last column of ``order`` has to make the order total.
    """
    limit = slice_limit(df, keys, rows_per_slice)
    if limit is None:
        return df.withColumns({"__slice": F.lit(None).cast("int"), "__halo": F.lit(False)})
    sliced = with_slices(df, keys, order, limit)
    newest_first = Window.partitionBy(*keys, "__slice").orderBy(*[F.desc(c) for c in order])
    row = F.struct(*order, *[c for c in dict.fromkeys([*keys, *carry]) if c not in order])
    tails = (
        sliced.filter(F.col("__slice").isNotNull())
        .withColumn("__from_end", F.row_number().over(newest_first))
        .filter(F.col("__from_end") <= lookback)
        .groupBy(*keys, "__slice")
        .agg(F.array_sort(F.collect_list(row)).alias("__tail"))
    )
    before = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(-lookback, -1)
    # every earlier slice holds at least one row, so `lookback` tails always reach far enough
    reach = F.flatten(F.collect_list("__tail").over(before))
    halo = (
        tails.withColumn("__reach", reach)
        .select(
            "__slice",
            F.explode(
                F.slice(
                    "__reach",
                    F.greatest(F.size("__reach") - lookback + 1, F.lit(1)),
                    lookback,
                )
            ).alias("__row"),
        )
        .select("__slice", "__row.*", F.lit(True).alias("__halo"))
    )
    return sliced.withColumn("__halo", F.lit(False)).unionByName(halo, allowMissingColumns=True)


def running_totals(
    df: DataFrame,
    groups: list[str],
    order: str,
    measures: list[str],
    rows_per_slice: int = ROWS_PER_SLICE,
    minima: list[str] = (),
    limit: float | None | str = "measure",
) -> DataFrame:
    """Inclusive running sums of ``measures`` by ascending ``order`` inside each group.

    ``df`` has one row per (group, order). Adds ``<m>_cum`` and ``<m>_total`` per measure,
    ``<order>_next``, the following order value in the group (null on the last), and for each of
    ``minima`` ``<m>_min_before``, its least non-null value on earlier rows. A caller that can
    bound the rows per group more cheaply than by counting ``df`` passes its own ``limit``.
    """
    df, keys = _key_columns(df, groups)
    if limit == "measure":
        limit = slice_limit(df, keys, rows_per_slice)
    if limit is None:
        return _running_in_slices(df, keys, order, measures, minima, None)
    sliced = with_slices(df, keys, [order], limit)
    slices = (
        sliced.filter(F.col("__slice").isNotNull())
        .groupBy(*keys, "__slice")
        .agg(
            *[F.sum(m).alias(f"__s_{m}") for m in measures],
            *[F.min(m).alias(f"__m_{m}") for m in minima],
            F.min(order).alias("__first"),
        )
    )
    along = Window.partitionBy(*keys).orderBy("__slice")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = slices.select(
        *keys,
        "__slice",
        *[F.sum(f"__s_{m}").over(earlier).alias(f"__b_{m}") for m in measures],
        *[F.sum(f"__s_{m}").over(whole).alias(f"__t_{m}") for m in measures],
        *[F.min(f"__m_{m}").over(earlier).alias(f"__n_{m}") for m in minima],
        F.lead("__first").over(along).alias("__after"),
    )
    return _running_in_slices(sliced, keys, order, measures, minima, offsets)


def _running_in_slices(df, keys, order, measures, minima, offsets) -> DataFrame:
    """Running totals inside each slice, or each whole key, plus what came before the slice."""
    parts = keys if offsets is None else [*keys, "__slice"]
    local = Window.partitionBy(*parts).orderBy(order)
    upto = local.rowsBetween(Window.unboundedPreceding, 0)
    part = local.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = df.withColumns(
        {
            **{f"__c_{m}": F.sum(m).over(upto) for m in measures},
            **{f"__p_{m}": F.sum(m).over(part) for m in measures},
            **{f"__o_{m}": F.min(m).over(local.rowsBetween(Window.unboundedPreceding, -1)) for m in minima},
            "__lead": F.lead(order).over(local),
        }
    )
    keep = [c for c in df.columns if c not in ("__all", "__slice")]
    if offsets is None:
        return out.select(
            *keep,
            *[F.col(f"__c_{m}").alias(f"{m}_cum") for m in measures],
            *[F.col(f"__p_{m}").alias(f"{m}_total") for m in measures],
            *[F.col(f"__o_{m}").alias(f"{m}_min_before") for m in minima],
            F.col("__lead").alias(f"{order}_next"),
        )
    out = _join_small(out, offsets, keys, ["__slice"])
    return out.select(
        *keep,
        *[(F.col(f"__c_{m}") + F.coalesce(f"__b_{m}", F.lit(0))).alias(f"{m}_cum") for m in measures],
        *[F.coalesce(f"__t_{m}", f"__p_{m}").alias(f"{m}_total") for m in measures],
        *[F.least(f"__o_{m}", f"__n_{m}").alias(f"{m}_min_before") for m in minima],
        F.coalesce("__lead", "__after").alias(f"{order}_next"),
    )


def exact_quantiles(
    df: DataFrame,
    groups: list[str],
    value: str,
    quantiles: list[float],
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Linear-interpolated quantiles, exact: columns groups, ``q``, ``quantile``.

    The values are reduced to distinct ones first, ranked by running totals, and only the two
    rows around each wanted rank survive; no group is ever held in one place.
    """
    distinct = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*groups, value)
        .agg(F.count(F.lit(1)).alias("__rows"))
    )
    # the rows of a group bound its distinct values, and counting them shuffles next to nothing
    limit = slice_limit(df, groups, rows_per_slice)
    ranked = running_totals(distinct, groups, value, ["__rows"], limit=limit)
    before = F.col("__rows_cum") - F.col("__rows")
    asked = F.array(*[F.lit(q) for q in quantiles])
    # the float rank position q * (n - 1) falls between two consecutive 0-based ranks
    pos = F.col("q") * (F.col("__rows_total") - 1)
    hits = (
        ranked.withColumn("q", F.explode(F.filter(
            asked,
            lambda q: (F.ceil(q * (F.col("__rows_total") - 1)) >= before)
            & (F.floor(q * (F.col("__rows_total") - 1)) < F.col("__rows_cum")),
        )))
        .withColumn("__pos", pos)
        .withColumn("__lo", F.when((F.floor("__pos") >= before) & (F.floor("__pos") < F.col("__rows_cum")), F.col(value)))
        .withColumn("__hi", F.when((F.ceil("__pos") >= before) & (F.ceil("__pos") < F.col("__rows_cum")), F.col(value)))
        .withColumn("__frac", F.col("__pos") - F.floor("__pos"))
    )
    return hits.groupBy(*groups, "q").agg(
        (F.max("__lo") + (F.max("__hi") - F.max("__lo")) * F.max("__frac")).alias("quantile")
    )


def positions(df: DataFrame, groups: list[str], hash_col: str, id_col: str, hash_span: int, buckets: int = 16_384) -> DataFrame:
    """Add ``position`` (0-based) by (hash, id) inside each group and ``group_rows``.

    A uniform integer hash in [0, hash_span) needs no sampled cut points: equal hash ranges are
    balanced already. Offsets are one row per (group, range).
    """
    width = -(-hash_span // buckets)
    ranged = df.withColumn("__range", F.floor(F.col(hash_col) / F.lit(width)).cast("int"))
    counts = ranged.groupBy(*groups, "__range").agg(F.count(F.lit(1)).alias("__n"))
    whole = Window.partitionBy(*groups)
    earlier = whole.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *groups,
        "__range",
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"),
        F.sum("__n").over(whole).alias("group_rows"),
    )
    local = Window.partitionBy(*groups, "__range").orderBy(hash_col, id_col)
    keys = [*groups, "__range"]
    offsets = offsets.withColumnsRenamed({k: f"__o_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:  # rows whose group or hash is null have a place too
        same = same & _same(k, f"__o_{k}")
    return (
        ranged.withColumn("__rank", F.row_number().over(local))
        .join(offsets, same)
        .withColumn("position", F.col("__before") + F.col("__rank") - 1)
        .drop("__range", "__rank", "__before", *[f"__o_{k}" for k in keys])
    )
