"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores, BENCH_RUNS the timed runs per query
(after one warm-up; the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from ledgerloom.session import build_session
from ledgerloom.workload.queries import REGISTRY

HEADLINE = (
    "latest_filing",
    "preferred_unit",
    "fallback_entity",
    "three_statement_join",
    "annual_panel",
    "quarterly_from_documents",
    "ratios_quarterly",
    "ffill",
    "median_impute",
    "winsorize",
    "clean_panel_full",
    "snapshot_last_non_null",
    "panel_percent_rank",
    "ranked_targets",
    "sector_summary",
    "universe_clean",
    "quintiles",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session(
        "ledgerloom-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
