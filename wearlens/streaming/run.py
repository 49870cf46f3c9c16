"""Starting streams and keeping their output exactly once."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def start(
    stream: DataFrame, process: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Run ``process`` on every micro-batch; without ``every`` on what is available now, then stop."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        stream.writeStream.foreachBatch(process)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def write_batch(df: DataFrame, folder: str, batch_id: int) -> None:
    """One sub-folder per micro-batch: a batch that runs again replaces its own output."""
    df.write.mode("overwrite").parquet(os.path.join(folder, f"batch={batch_id}"))
