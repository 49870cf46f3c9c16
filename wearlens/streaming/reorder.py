"""Streams whose rows come out of order, and pairs of streams that should tell the same."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from wearlens.streaming.run import write_batch


class ReorderBuffer:
    """foreachBatch target: hands rows on in event time, as soon as no earlier one is to come.

    The mark is the newest event time seen less the allowed lateness. Rows before the mark are handed
    to ``sink``; the others wait in the buffer, which so holds one lateness of rows. Rows that come
    in before the mark reached earlier, or without a time, go to ``late``. Whatever the order of
    arrival within the lateness, ``sink`` sees every time after all earlier ones. Buffer and mark
    alternate between two folders by batch number, so a batch that runs again starts as it did before.
    """

    def __init__(self, folder: str, sink: Callable[[DataFrame, int], None], lateness_seconds: int, at: str = "ts"):
        self.folder, self.sink, self.lateness, self.at = folder, sink, lateness_seconds, at
        self.late = os.path.join(folder, "late")

    def _slot(self, batch_id: int, what: str) -> str:
        return os.path.join(self.folder, f"{what}-{batch_id % 2}")

    def _before(self, batch: DataFrame, batch_id: int) -> tuple[DataFrame, int | None]:
        """Rows that wait and the mark in microseconds, as the batch before left them."""
        if batch_id == 0:
            return batch.limit(0), None
        spark = batch.sparkSession
        mark = spark.read.schema("mark long").parquet(self._slot(batch_id - 1, "mark")).first()  # one row
        return spark.read.schema(batch.schema).parquet(self._slot(batch_id - 1, "waiting")), mark["mark"]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        waiting, mark = self._before(batch, batch_id)
        at = F.unix_micros(self.at)
        on_time = at.isNotNull() if mark is None else F.coalesce(at >= mark, F.lit(False))
        write_batch(batch.filter(~on_time), self.late, batch_id)
        newest = batch.agg(F.max(at)).first()[0]
        marks = [m for m in (mark, None if newest is None else newest - self.lateness * 1_000_000) if m is not None]
        self._hand_on(batch.filter(on_time).unionByName(waiting), max(marks) if marks else None, batch_id)
        batch.unpersist()

    def _hand_on(self, rows: DataFrame, mark: int | None, batch_id: int) -> None:
        ready = F.lit(False) if mark is None else F.unix_micros(self.at) < mark
        rows.filter(~ready).write.mode("overwrite").parquet(self._slot(batch_id, "waiting"))
        rows.sparkSession.createDataFrame([(mark,)], "mark long").coalesce(1).write.mode("overwrite").parquet(self._slot(batch_id, "mark"))
        self.sink(rows.filter(ready), batch_id)

    def close(self, spark: SparkSession, last_batch: int) -> None:
        """The stream has ended after ``last_batch``: hand on what still waits, as one more batch."""
        waiting = spark.read.parquet(self._slot(last_batch, "waiting"))
        newest = waiting.agg(F.max(F.unix_micros(self.at))).first()[0]
        if newest is not None:
            self._hand_on(waiting, newest + 1, last_batch + 1)


def live_reconcile(left: DataFrame, right: DataFrame, marker: str, within: str = "10 minutes", lateness: str = "10 minutes", at: str = "ts") -> DataFrame:
    """``marker, status`` of invocations that only one of two live logs tells of, once their time is over.

    Lines of one invocation are at most ``within`` apart and come at most ``lateness`` behind the newest
    of their log; the join keeps no line for longer than both. The slower log sets the pace. Lines
    without a marker only move time on.
    """
    def side(log: DataFrame, name: str) -> DataFrame:
        told = log.select(F.col(marker).alias(f"{name}_marker"), F.col(at).alias(f"{name}_at"))
        return told.withWatermark(f"{name}_at", lateness).dropDuplicatesWithinWatermark([f"{name}_marker"])

    span = F.expr(f"INTERVAL {within}")
    near = F.col("right_at").between(F.col("left_at") - span, F.col("left_at") + span)
    both = side(left, "left").join(side(right, "right"), (F.col("left_marker") == F.col("right_marker")) & near, "full_outer")
    one = both.filter(F.col("left_at").isNull() | F.col("right_at").isNull())
    status = F.when(F.col("right_at").isNull(), "missing_in_right").otherwise("missing_in_left")
    return one.select(F.coalesce("left_marker", "right_marker").alias(marker), status.alias("status")).filter(F.col(marker).isNotNull())
