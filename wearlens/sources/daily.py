"""Logs and series laid out by day, so that a lookback reads its own days only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def write_daily(df: DataFrame, path: str, at: str = "ts") -> None:
    """Append rows under ``day=<date of at>``; rows without a time get a day of their own that no lookback reads."""
    df.withColumn("day", F.to_date(at)).write.mode("append").partitionBy("day").parquet(path)


def write_log_daily(lines: DataFrame, path: str) -> None:
    """The same for JSON log lines (column ``value``), by the date they tell; unreadable lines are kept without a day."""
    told = F.to_date(F.try_to_timestamp(F.get_json_object("value", "$.timestamp")))
    lines.select("value", told.alias("day")).write.mode("append").partitionBy("day").text(path)


def _days(as_of, minutes: int) -> Column:
    end = F.lit(as_of).cast("timestamp")
    return F.col("day").between(F.to_date(end - F.make_dt_interval(mins=F.lit(minutes))), F.to_date(end))


def read_lookback(spark: SparkSession, path: str, as_of, minutes: int, at: str = "ts") -> DataFrame:
    """Rows of the last ``minutes`` up to ``as_of``; the bound prunes days before any file is read."""
    end = F.lit(as_of).cast("timestamp")
    recent = (F.col(at) > end - F.make_dt_interval(mins=F.lit(minutes))) & (F.col(at) <= end)
    return spark.read.parquet(path).filter(_days(as_of, minutes)).filter(recent).drop("day")


def read_log_since(spark: SparkSession, path: str, as_of, minutes: int) -> DataFrame:
    """Lines of the days from ``minutes`` before ``as_of`` on, for ``files.prediction_log`` to cut exactly."""
    since = F.lit(as_of).cast("timestamp") - F.make_dt_interval(mins=F.lit(minutes))
    return spark.read.text(path).filter(F.col("day") >= F.to_date(since)).select("value")
