"""Column profiles of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wearlens.contract import LABEL, SENSORS
from wearlens.operators.cleaning import absent
from wearlens.operators.ordered import ROWS_PER_SLICE, exact_quantiles


def unpivot_numeric(df: DataFrame, columns: list[str], keep: list[str] = ()) -> DataFrame:
    """``keep..., column, value`` with values as doubles; NaN is null."""
    number = {c: F.col(c).cast("double") for c in columns}
    pairs = [F.struct(F.lit(c).alias("column"), F.when(~F.isnan(x), x).alias("value")) for c, x in number.items()]
    return df.select(*keep, F.inline(F.array(*pairs)))


def numeric_profile(df: DataFrame, columns=SENSORS, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Mean, sample std, min, exact quartiles and max of each column."""
    long = unpivot_numeric(df, columns).filter(F.col("value").isNotNull())
    moments = long.groupBy("column").agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    names = {0.25: "p25", 0.5: "p50", 0.75: "p75"}
    quartiles = exact_quantiles(long, ["column"], "value", list(names), rows_per_slice)
    wide = quartiles.groupBy("column").agg(
        *[F.max(F.when(F.col("q") == q, F.col("quantile"))).alias(n) for q, n in names.items()]
    )
    return moments.join(wide, "column")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """``value, rows`` in descending order of rows."""
    return (
        df.groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.desc("rows"), "value")
    )


def label_balance(df: DataFrame, label: str = LABEL) -> DataFrame:
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("rows"))
    return counts.select("label", "rows", (F.col("rows") / df.agg(F.count(F.lit(1))).scalar()).alias("share"))


def missingness(df: DataFrame) -> DataFrame:
    """``column, nulls`` for every column, zeros included, from one aggregate; NaN counts as null."""
    counts = df.agg(*[F.count_if(absent(df, c)).alias(c) for c in df.columns])
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in df.columns]
    return counts.select(F.inline(F.array(*pairs)))
