"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 4) choose
data and cores. Each query is written to the no-op sink, so it runs whole.
BENCH_QUERIES may name other queries, separated by commas, or "all".
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shiftledger.catalog.queries import QUERIES  # noqa: E402
from shiftledger.session import build_session  # noqa: E402

HEADLINE = [
    "monthly_hours",
    "payroll_hours",
    "monthly_hours_lines",
    "payroll_hours_lines",
    "active_names",
    "unassigned_time",
    "flat_entries",
    "upsert_entries",
    "ghost_entries",
    "window_sync",
    "window_sync_stats",
    "backfill",
    "resolve_links",
    "assignment_index",
    "payroll_actions",
    "dedup_updates",
    "assignment_updates",
    "diff_stats",
    "action_batches",
    "match_identity",
    "nudge_rows",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "4")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "4g"),
            # Kept off the console, where it would mix with the result line.
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # First touch of the JVM, the reader and the code generator is not the query's time.
    QUERIES["monthly_hours"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds = {}
    for name in names:
        best = None
        for _ in range(repeats):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
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
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
