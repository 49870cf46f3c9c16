"""Scoring requests on a stream: stateless, with a second sink for what the contract rejects."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, functions as F

from wearlens.contract import SENSORS
from wearlens.operators.requests import accepted, check_requests, rejected, request_features
from wearlens.operators.training import with_actions
from wearlens.sources.files import event_lines
from wearlens.streaming.run import write_batch


class RequestSink:
    """foreachBatch target: features or scores of accepted requests, and the errors of the others.

    ``score`` maps a feature frame to one with ``score``; without it the features are written.
    Scores are also written as structured log lines.
    """

    def __init__(self, folder: str, score=None, version: str = "1"):
        self.score, self.version = score, version
        self.accepted, self.rejected = os.path.join(folder, "accepted"), os.path.join(folder, "rejected")
        self.log = os.path.join(folder, "log")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        checked = check_requests(batch).persist()
        refused = rejected(checked)
        write_batch(refused, self.rejected, batch_id)
        out = request_features(accepted(checked))
        lines = event_lines(refused.select("request_id", "ts", "errors"), "validation_rejected", "WARNING")
        if self.score is not None:
            out = with_actions(self.score(out), self.version)
            write_batch(out, self.accepted, batch_id)  # scored once: the log lines read what was written
            out = batch.sparkSession.read.schema(out.schema).parquet(os.path.join(self.accepted, f"batch={batch_id}"))
            told = [
                "vehicle_id", "readings_used", "failure_probability", "recommended_action", "model_version",
            ]
            raw = F.struct(*SENSORS).alias("features")  # the last reading as it came: what drift compares
            made = out.select("ts", F.col("type").alias("machine_type"), *told, raw)
            lines = lines.unionByName(event_lines(made, "prediction_made"))
        else:
            write_batch(out, self.accepted, batch_id)
        lines.write.mode("overwrite").text(os.path.join(self.log, f"batch={batch_id}"))
        checked.unpersist()
