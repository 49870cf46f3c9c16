"""Checks for the quiet failures: leaked labels and bad inputs that score without an error."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wearlens.contract import FAILURE_FLAGS, LABEL, MACHINE_TYPES, SENSORS
from wearlens.operators.cleaning import absent, any_of
from wearlens.operators.metrics import ranking_metrics
from wearlens.operators.ordered import ROWS_PER_SLICE


def leak_audit(
    df: DataFrame, candidates=FAILURE_FLAGS, label: str = LABEL, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Per suspect column, and for the OR of all: agreement with the label and ROC-AUC as a score."""
    any_flag = F.greatest(*[F.col(c) for c in candidates])
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("score")) for c in candidates]
    pairs.append(F.struct(F.lit("any_flag").alias("column"), any_flag.cast("double").alias("score")))
    long = df.select(F.col(label).alias("label"), F.inline(F.array(*pairs)))
    agree = long.groupBy("column").agg(F.avg((F.col("score") == F.col("label")).cast("double")).alias("agreement"))
    auc = ranking_metrics(long, ["column"], rows_per_slice).select("column", "roc_auc", "pr_auc")
    return agree.join(auc, "column")


def bad_input_audit(df: DataFrame, sensors=SENSORS, known=MACHINE_TYPES) -> DataFrame:
    """Share of rows a model would score although a category is unknown or a sensor is missing."""
    unseen = ~F.coalesce(F.col("type").isin(known), F.lit(False))
    missing = any_of([absent(df, c) for c in sensors])
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(unseen).alias("unseen_category"),
        F.count_if(missing).alias("missing_sensor"),
        F.avg((unseen | missing).cast("double")).alias("bad_share"),
    )
