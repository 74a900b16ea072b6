"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR    table folder (default /root/testdata/sf0.1)
BENCH_CPUS      local cores (default 8)
BENCH_REPEAT    timed runs per query after one warm-up; the median counts (default 2,
                for every query)
BENCH_QUERIES   comma-separated names, or "all"
"""

from __future__ import annotations

import json
import os
import statistics
import time

from starmill.session import drop_scratch, local_session
from starmill.workload.queries import QUERIES

HEADLINE = [
    "csv_scan",
    "multi_file_scan",
    "dedup_calendar",
    "product_clean",
    "dedup_latest",
    "silver_order_items",
    "remap_orphans",
    "dim_customers",
    "dim_products",
    "fact_order_items",
    "check_grain_composite",
    "check_referential",
    "dq_report",
    "full_refresh_rerun",
]


def seconds(spark, name: str, sf_dir: str) -> float:
    """Plan and run once; every row is produced and none is kept."""
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else [n for n in wanted.split(",") if n] or HEADLINE

    spark = local_session(cores, partitions=int(cores) if cores.isdigit() else 8)
    times = {}
    for name in names:
        seconds(spark, name, sf_dir)
        times[name] = round(statistics.median(seconds(spark, name, sf_dir) for _ in range(repeat)), 3)
    drop_scratch(spark)
    print(
        json.dumps(
            {
                "metric": "headline_query_seconds_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cores,
            }
        )
    )


if __name__ == "__main__":
    main()
