"""Classification metrics over ``label`` (0/1) and ``score``, for the whole table or per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wearlens.contract import FN_COST, FP_COST
from wearlens.functions.search import upper_bound
from wearlens.operators.ordered import ROWS_PER_SLICE, running_totals, slice_limit

# fixed values: 181 thresholds from 0.05 to 0.95
SCAN = [0.05 + i * ((0.95 - 0.05) / 180) for i in range(180)] + [0.95]


def ratio(top: Column, bottom: Column, empty: float | None = 0.0) -> Column:
    return F.when(bottom != 0, top / bottom).otherwise(F.lit(empty).cast("double"))


def f2(tp: Column, fp: Column, fn: Column) -> Column:
    return ratio(5 * tp, 5 * tp + 4 * fn + fp)


def confusion(df: DataFrame, threshold: float | Column, groups: list[str] = ()) -> DataFrame:
    """All four cells at ``score >= threshold``, zeros included."""
    hit = F.col("score") >= threshold
    pos = F.col("label") == 1
    return df.groupBy(*groups).agg(
        F.count_if(~pos & ~hit).alias("tn"),
        F.count_if(~pos & hit).alias("fp"),
        F.count_if(pos & ~hit).alias("fn"),
        F.count_if(pos & hit).alias("tp"),
    )


def rates(cells: DataFrame, fn_cost: float = FN_COST, fp_cost: float = FP_COST) -> DataFrame:
    """Precision, recall, F2, error rates and expected cost from the four cells.

    Precision, recall and F2 are 0 where undefined; the error rates of an empty class are null.
    """
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    return cells.withColumns(
        {
            "n_samples": n,
            "n_positive": tp + fn,
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
            "f2_score": f2(tp, fp, fn),
            "fn_rate": ratio(fn, tp + fn, None),
            "fp_rate": ratio(fp, tn + fp, None),
            "expected_cost_per_1000": ratio((fn_cost * fn + fp_cost * fp) * 1000.0, n, None),
        }
    )


def classification_report(df: DataFrame, threshold: float, groups: list[str] = ()) -> DataFrame:
    """Cells, rates and Brier score in one aggregate."""
    pos, hit = F.col("label") == 1, F.col("score") >= threshold
    cells = df.groupBy(*groups).agg(
        F.count_if(~pos & ~hit).alias("tn"),
        F.count_if(~pos & hit).alias("fp"),
        F.count_if(pos & ~hit).alias("fn"),
        F.count_if(pos & hit).alias("tp"),
        brier().alias("brier_score"),
    )
    return rates(cells).withColumn("threshold", F.lit(threshold))


def brier() -> Column:
    return F.avg(F.pow(F.col("score") - F.col("label"), 2))


def threshold_scan(df: DataFrame, thresholds: list[float] = SCAN, groups: list[str] = ()) -> DataFrame:
    """Cells and F2 at every threshold from one pass over the scores.

    A score is reduced to the number of thresholds it reaches; those at most 182 counts per group
    are then summed from the top.
    """
    passed = upper_bound(F.array(*[F.lit(t) for t in thresholds]), F.col("score"), len(thresholds))
    counts = (
        df.withColumn("__passed", passed)
        .groupBy(*groups, "__passed")
        .agg(F.count_if(F.col("label") == 1).alias("__pos"), F.count_if(F.col("label") != 1).alias("__neg"))
    )
    each = counts.select(
        *groups, "__passed", "__pos", "__neg",
        F.posexplode(F.array(*[F.lit(t) for t in thresholds])).alias("__i", "threshold"),
    )
    reached = F.col("__passed") > F.col("__i")

    def total(name, cond):
        return F.sum(F.when(cond, F.col(name)).otherwise(0))

    cells = each.groupBy(*groups, "threshold").agg(
        total("__neg", ~reached).alias("tn"),
        total("__neg", reached).alias("fp"),
        total("__pos", ~reached).alias("fn"),
        total("__pos", reached).alias("tp"),
    )
    return cells.withColumn("f2_score", f2(F.col("tp"), F.col("fp"), F.col("fn")))


def best_threshold(df: DataFrame, thresholds: list[float] = SCAN, groups: list[str] = ()) -> DataFrame:
    """The threshold with the highest F2, the lowest one on a tie."""
    best = F.max(F.struct("f2_score", (-F.col("threshold")).alias("down"))).alias("__best")
    return (
        threshold_scan(df, thresholds, groups)
        .groupBy(*groups)
        .agg(best)
        .select(*groups, (-F.col("__best.down")).alias("threshold"), F.col("__best.f2_score").alias("f2_score"))
    )


def ranking_metrics(df: DataFrame, groups: list[str] = (), rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Step-wise average precision and ROC-AUC with half credit for ties.

    Equal scores are merged first, then ranked from the top by running totals. A group with one
    class only gets nulls and the reason.
    """
    groups = list(groups)
    merged = (
        df.withColumn("__down", -F.col("score"))
        .groupBy(*groups, "__down")
        .agg(F.count_if(F.col("label") == 1).alias("__pos"), F.count_if(F.col("label") != 1).alias("__neg"))
    )
    limit = slice_limit(df, groups, rows_per_slice)  # rows bound the distinct scores
    run = running_totals(merged, groups, "__down", ["__pos", "__neg"], limit=limit)
    pos, neg = F.col("__pos"), F.col("__neg")
    below = F.col("__neg_total") - F.col("__neg_cum")
    sums = run.groupBy(*groups).agg(
        F.sum(pos * (F.col("__pos_cum") / (F.col("__pos_cum") + F.col("__neg_cum")))).alias("__ap"),
        F.sum(pos.cast("double") * (below + neg / 2)).alias("__pairs"),
        F.max("__pos_total").alias("positives"),
        F.max("__neg_total").alias("negatives"),
    )
    both = (F.col("positives") > 0) & (F.col("negatives") > 0)
    return sums.select(
        *groups,
        F.when(both, F.col("__ap") / F.col("positives")).alias("pr_auc"),
        F.when(both, F.col("__pairs") / (F.col("positives").cast("double") * F.col("negatives"))).alias("roc_auc"),
        F.when(F.col("positives") == 0, "no positives").when(F.col("negatives") == 0, "no negatives").alias("reason"),
    )
