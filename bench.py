"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the data, BENCH_CPUS (default 8) the local cores. Each query runs
once unmeasured and then BENCH_RUNS times (default 2), of which the fastest counts; all rows are produced.
"""

from __future__ import annotations

import json
import os
import time

from checks.queries import QUERIES
from kpi_shift.session import local_session

HEADLINE = (
    "clean_kpis",
    "detect_events",
    "baseline_stats",
    "score_post_event",
    "tickets_near_tower",
    "work_orders_per_tower",
    "tower_report",
    "carrier_report",
    "impacted_users",
    "normalise_failures",
    "score_range",
    "completeness_report",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cpus, "bench")
    seconds = {}
    for name in HEADLINE:
        best = None
        for attempt in range(runs + 1):
            began = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - began
            if attempt:
                best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
