"""Time the headline queries at $BENCH_SF_DIR, each once after a warm-up query, and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from wearlens.plans.catalog import all_queries
from wearlens.session import local_session

# the queries timed by default, without the rounding the oracle comparison adds: one or two per operator family
HEADLINE = [
    "clean_dataset", "clean_report", "contract_failures", "numeric_profile", "rolling_features",
    "rolling_features_blocked", "rolling_by_vehicle", "request_contract", "request_features", "stratified_split",
    "threshold_scan", "average_precision", "report_by_type", "leaderboard", "champion_challenger", "drift_summary",
    "drift_psi", "drift_by_window", "latency_quantiles", "throughput", "series_gaps", "asof_fill", "rf_scores",
    "calibrated_scores", "experiment_grid", "stream_rolling_features", "stream_rejections", "stream_status_mix",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    queries["clean_report"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # start the JVM's workers
    times: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
