"""Seeded, exact, stratified splits that depend on the row id alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wearlens.contract import SEED
from wearlens.functions.search import HASH_PRIME, portable_hash
from wearlens.operators.ordered import positions

SPLITS = ["train", "validation", "test"]


def _ranked(df: DataFrame, label: str, id_col: str, seed: int) -> DataFrame:
    hashed = df.withColumn("__hash", portable_hash(id_col, seed))
    return positions(hashed, [label], "__hash", id_col, HASH_PRIME).drop("__hash")


def stratified_split(df: DataFrame, label: str = "label", id_col: str = "unit_id", seed: int = SEED) -> DataFrame:
    """Add ``split``: per class exactly a fifth to test and a quarter of the rest to validation, rounded.

    The same id always lands in the same split, whatever columns or windows ``df`` carries.
    """
    tenth = F.floor((F.col("group_rows") * 2 + 5) / 10)
    quarter = F.floor((F.col("group_rows") - tenth + 2) / 4)
    split = (
        F.when(F.col("position") < tenth, "test")
        .when(F.col("position") < tenth + quarter, "validation")
        .otherwise("train")
    )
    return _ranked(df, label, id_col, seed).withColumn("split", split).drop("position", "group_rows")


def stratified_folds(
    df: DataFrame, k: int = 5, label: str = "label", id_col: str = "unit_id", seed: int = SEED
) -> DataFrame:
    """Add ``fold`` in 0..k-1; class counts differ by at most one between folds."""
    ranked = _ranked(df, label, id_col, seed)
    return ranked.withColumn("fold", (F.col("position") % k).cast("int")).drop("position", "group_rows")


def split_report(split: DataFrame, by: str = "split", label: str = "label") -> DataFrame:
    return split.groupBy(by).agg(F.count(F.lit(1)).alias("rows"), F.sum(label).alias("positives"))


def split_audit(split: DataFrame, by: str = "split", label: str = "label", min_positives: int = 5) -> DataFrame:
    """Flag parts whose ranking metrics would be undefined or meaningless, with the reason."""
    negatives = F.col("rows") - F.col("positives")
    reason = (
        F.when(F.col("positives") == 0, "no positives")
        .when(negatives == 0, "no negatives")
        .when(F.col("positives") < min_positives, "too few positives")
    )
    return split_report(split, by, label).select(
        by, "rows", "positives", reason.isNotNull().alias("degenerate"), reason.alias("reason")
    )


def reference_sample(df: DataFrame, n: int | None = None, id_col: str = "unit_id", seed: int = 13) -> DataFrame:
    """All rows, or exactly ``n``: the smallest by (hash, id), as a distributed top-n."""
    if n is None:
        return df
    return df.withColumn("__hash", portable_hash(id_col, seed)).orderBy("__hash", id_col).limit(n).drop("__hash")


def fit_sample(df: DataFrame, n: int, id_col: str = "unit_id", seed: int = SEED) -> DataFrame:
    """At most ``n`` rows for a fit on a part that ``seed`` has split.

    Splits and folds cut each class along the hash of ``seed``. The smallest by that same hash would be
    the rows next to a part's edge, which lies elsewhere for each class: shares of the classes would be
    left to chance, and in large tables one class missing. So the sample goes by another hash. Its last
    row is found on the ids alone, one row that is fetched; whole rows are sorted only up to that one.
    """
    at = F.struct(portable_hash(id_col, seed + 1).alias("hash"), F.col(id_col).cast("long").alias("id"))
    last = df.select(at.alias("at")).orderBy("at").limit(n).agg(F.max("at")).first()[0]
    upto = df if last is None else df.filter(at <= F.struct(F.lit(last["hash"]).cast("long"), F.lit(last["id"]).cast("long")))
    return reference_sample(upto, n, id_col, seed + 1)


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """``label, rows, weight`` with weight = n / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    whole = counts.agg(F.sum("rows").alias("n"), F.count(F.lit(1)).alias("k"))
    share = whole.select(F.col("n") / F.col("k")).scalar()
    return counts.select(label, "rows", (share / F.col("rows")).alias("weight"))
