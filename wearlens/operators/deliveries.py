"""Ids of all accepted deliveries, as bitmaps: a delivery is checked against them without reading earlier rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wearlens.operators.validation import validate, wrong_types
from wearlens.sources import committed

BLOCKS = "block long, bits long"


def id_blocks(df: DataFrame, id_col: str = "unit_id") -> DataFrame:
    """``block, bits``: 64 neighbouring ids a row, combined before the shuffle. Null ids have no bit."""
    at = F.col(id_col).cast("long")
    bit = F.expr(f"shiftleft(1L, cast(cast(`{id_col}` as long) & 63L as int))")
    return df.filter(at.isNotNull()).groupBy(F.shiftright(at, 6).alias("block")).agg(F.bit_or(bit).alias("bits"))


def merged(blocks: DataFrame) -> DataFrame:
    return blocks.groupBy("block").agg(F.bit_or("bits").alias("bits"))


def ids_of(blocks: DataFrame, id_col: str = "unit_id") -> DataFrame:
    held = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.getbit("bits", i) == 1)
    return blocks.select(F.explode(F.transform(held, lambda i: F.col("block") * 64 + i)).alias(id_col))


def seen_before(delivery: DataFrame, known: DataFrame, id_col: str = "unit_id") -> DataFrame:
    """Ids of ``delivery`` that ``known`` blocks hold, each once. Only blocks are joined, at most one a side and key."""
    mine, theirs = id_blocks(delivery, id_col), merged(known).withColumnRenamed("bits", "known")
    both = mine.join(theirs, "block").select("block", F.col("bits").bitwiseAND(F.col("known")).alias("bits"))
    return ids_of(both.filter("bits <> 0"), id_col)


def known_ids(spark: SparkSession, index: str, but: str | None = None) -> DataFrame:
    """The index's blocks, without those of the delivery ``but``."""
    if all(c.key == but for c in committed.commits(spark, index)):
        return spark.createDataFrame([], BLOCKS)
    return committed.read(spark, index, but)


def accept_delivery(df: DataFrame, table: str, index: str, key: str, id_col: str = "unit_id") -> tuple[bool, DataFrame]:
    """Append the delivery ``key`` when the contract holds and none of its ids came before: whether it did, and the failures by check.

    The index is committed first, then the rows. A job that dies between the two is run again with
    its key: its own blocks don't count against it, and what is committed is not written twice.
    Deliveries are accepted one at a time.
    """
    spark = df.sparkSession
    if key in committed.keys(spark, table):
        return True, spark.createDataFrame([], "column string, check string, failures long")
    valid, failures = validate(df)
    if wrong_types(df):
        return False, failures
    again = seen_before(df, known_ids(spark, index, key), id_col)
    repeated = again.agg(F.count(F.lit(1)).alias("failures")).filter("failures > 0")
    failures = failures.unionByName(repeated.select(F.lit(id_col).alias("column"), F.lit("delivered_before").alias("check"), "failures"))
    if not valid or not again.isEmpty():
        return False, failures
    committed.append(id_blocks(df, id_col), index, key)
    committed.append(df, table, key)
    return True, failures


def compact(spark: SparkSession, index: str, key: str) -> None:
    """One row per block again, after many deliveries; not while one is being accepted, as its own blocks could not be told apart."""
    committed.replace(merged(known_ids(spark, index)), index, key)
