"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs in full into a sink that keeps nothing, so every row and column is computed.
The time includes building and planning the query. The first run of each query is not counted; of the
others ($BENCH_RUNS, 1 if unset) the median is.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from statistics import median

HEADLINE = [
    "flatten_states",
    "clean_states",
    "nearest_region",
    "nearest_of_many",
    "resolve_airline",
    "export_events",
    "clean_events",
    "traffic_by_bucket",
    "rolling_baseline",
    "anomaly_score",
    "anomaly_score_dense",
    "incremental_score",
    "recent_history",
    "status_as_of",
    "merge_history",
    "upsert_traffic",
    "upsert_events",
    "drop_event_correlation",
    "serving_traffic",
    "kpi_summary",
    "top_airlines",
    "zone_counts",
    "altitude_bands",
    "top_events",
    "corridors",
    "load_serving",
    "stream_clean_states",
    "stream_traffic_by_bucket",
    "stream_anomaly_score",
]


def main() -> None:
    here = os.path.dirname(os.path.abspath(__file__))
    sys.path.insert(0, here)
    os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [here, os.environ.get("PYTHONPATH")]))
    from skytally.plans.registry import QUERIES
    from skytally.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "skytally-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="skytally-bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    def timed(name: str) -> float:
        run(name)
        return median(run(name) for _ in range(int(os.environ.get("BENCH_RUNS", "1"))))

    seconds = {name: timed(name) for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")}
    spark.stop()
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
