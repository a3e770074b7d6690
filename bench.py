"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables (default /root/testdata/sf0.1), ``BENCH_CPUS`` the local
cores. Each query's result is fully computed by the no-op sink; the best of ``BENCH_RUNS``
runs counts, after one untimed query that warms the session up.
"""

from __future__ import annotations

import json
import os
import time

from changetrail import build_session
from changetrail.workloads import QUERIES

HEADLINE = (
    "conform_feed",
    "lag_previous",
    "change_log",
    "change_log_reference",
    "change_log_with_previous",
    "change_log_composite_key",
    "change_log_hot_keys",
    "latest_values",
    "pivot_log",
    "baseline_strict",
    "baseline_reference",
    "initial_change_log",
    "incremental_change_log",
    "incremental_change_log_reference",
    "incremental_change_log_ties",
    "incremental_change_log_hot_keys",
    "held_rows",
    "feed_historical",
    "log_append_roundtrip",
    "log_scan_table",
    "purge_table",
    "run_report",
    "stream_change_log",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session(
        "changetrail-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    seconds("incremental_change_log")
    times = {name: round(min(seconds(name) for _ in range(runs)), 3) for name in names}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
