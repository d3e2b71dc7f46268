"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

All queries run once to warm up and then three times in turn, so that none of them has the
start-up of the session to itself; a query's figure is the median, its spread the fastest and the
slowest run.  Every row and column is produced (noop sink).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tallyspan.registry.queries import REGISTRY
from tallyspan.session import build_session

HEADLINE = [
    "mart",
    "mart_sparse",
    "mart_edge",
    "daily_metrics",
    "state_history_sparse",
    "daily_states",
    "asof_lookup",
    "license_daily_series",
    "daily_events",
    "dq_report",
    "dq_flagged_rows",
    "prof_transitions",
    "toggle_states",
    "assign_batches",
    "inc_upsert",
    "recompute_affected",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    runs: dict[str, list[float]] = {name: [] for name in names}
    for _ in range(4):
        for name in names:
            started = time.perf_counter()
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs[name].append(time.perf_counter() - started)
    seconds = {name: round(statistics.median(r[1:]), 3) for name, r in runs.items()}
    spread = {name: [round(min(r[1:]), 3), round(max(r[1:]), 3)] for name, r in runs.items()}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "spread": spread,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
