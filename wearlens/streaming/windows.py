"""Live windowed metrics and periodic drift."""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from wearlens.operators.drift import CATEGORICAL, NUMERIC, added, drift_of_counts, summarize, value_counts
from wearlens.session import folders, remove
from wearlens.streaming.run import start, write_batch

COUNTS = "column string, value double, category string, rows long"


def live(
    log: DataFrame, metric: Callable[[DataFrame], DataFrame], folder: str, checkpoint: str,
    lateness: str = "10 minutes", every: str | None = None,
):
    """Run a batch metric such as ``throughput`` on a stream of the request log.

    The watermark bounds the state; changed windows are written per micro-batch in update mode.
    """
    changed = metric(log.withWatermark("ts", lateness))
    return start(changed, lambda df, i: write_batch(df, folder, i), checkpoint, every, mode="update")


def current_values(spark: SparkSession, folder: str, keys: list[str]) -> DataFrame:
    """The newest version of every window that ``live`` wrote."""
    df = spark.read.parquet(folder)
    rest = [c for c in df.columns if c not in (*keys, "batch")]
    newest = F.max_by(F.struct(*rest), "batch")
    return df.groupBy(*keys).agg(newest.alias("v")).select(*keys, "v.*")


class DriftSink:
    """foreachBatch target: drift of the trailing days against a reference, one summary per batch.

    A day is kept as its counts per value (``drift.value_counts``), which add up. A batch adds its
    counts to the days it touches and writes these days anew, as ``batch=<id>/day=<day>``; a window
    takes the newest version of each of its days. So a batch reads the counts of the window's days,
    however many batches have come, and no row twice. A batch that runs again starts from the
    versions before it; older ones are deleted.
    """

    def __init__(self, folder: str, reference: DataFrame, days: int, at: str = "ts", columns=(NUMERIC, CATEGORICAL)):
        self.history, self.summaries = os.path.join(folder, "history"), os.path.join(folder, "summaries")
        self.reference, self.days, self.at, self.columns = os.path.join(folder, "reference"), days, at, columns
        value_counts(reference, *columns).write.mode("overwrite").parquet(self.reference)

    def versions(self, spark: SparkSession) -> dict[str, list[int]]:
        """Batches that wrote each day: names of folders, two a day."""
        found: dict[str, list[int]] = {}
        for path in folders(spark, os.path.join(self.history, "batch=*", "day=*")):
            batch, day = re.search(r"batch=(\d+)/day=([^/]+)", path).groups()
            found.setdefault(day, []).append(int(batch))
        return found

    def counts(self, spark: SparkSession, newest: dict[str, int]) -> DataFrame:
        """The named version of each day."""
        paths = [os.path.join(self.history, f"batch={b}", f"day={d}") for d, b in newest.items()]
        reader = spark.read.schema(f"{COUNTS}, day date").option("basePath", self.history)
        return (reader.parquet(*paths) if paths else spark.createDataFrame([], f"{COUNTS}, day date")).drop("batch")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.withColumn("day", F.to_date(self.at)).filter("day is not null")
        days = {str(r.day): r.at for r in batch.groupBy("day").agg(F.max(self.at).alias("at")).collect()}  # one row a day
        if not days:
            return
        before = {d: max(b for b in v if b < batch_id) for d, v in self.versions(spark).items() if min(v) < batch_id}
        own = value_counts(batch, *self.columns, groups=["day"])
        known = self.counts(spark, {d: b for d, b in before.items() if d in days})
        merged = added(own.unionByName(known), ["day"])
        merged.write.mode("overwrite").partitionBy("day").parquet(os.path.join(self.history, f"batch={batch_id}"))
        last = max(days)
        first = str(date.fromisoformat(last) - timedelta(days=self.days - 1))
        window = self.counts(spark, {d: b for d, b in (before | dict.fromkeys(days, batch_id)).items() if first <= d <= last})
        by_column = drift_of_counts(spark.read.schema(COUNTS).parquet(self.reference), added(window), *self.columns)
        write_batch(summarize(by_column).withColumn("as_of", F.lit(days[last])), self.summaries, batch_id)
        for day, batches in self.versions(spark).items():
            for b in batches:
                if b < before.get(day, -1):
                    remove(spark, os.path.join(self.history, f"batch={b}", f"day={day}"))
