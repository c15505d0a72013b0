"""Times the headline queries: one JSON line with the seconds of each and their sum.

Every query runs once to warm up and then ``BENCH_RUNS`` times; the median counts. Results
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from reachmart.catalog import QUERIES
from reachmart.session import local_session

HEADLINE = [
    "segment_scores",
    "customer_360",
    "dim_customer",
    "lookback_revenue",
    "cohort_retention",
    "fct_orders",
    "stg_ad_spend",
    "kpi_by_filter",
    "hist_revenue",
    "revenue_by_country",
    "segment_performance",
    "top_active",
    "activation_payload",
    "lead_rows",
    "task_rows",
    "model_risk",
    "repair_manual",
    "unsent_by_id_email",
    "sent_status",
    "find_customer",
    "record_detail",
    "dq_report",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = sys.argv[1:] or HEADLINE
    spark = local_session(cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in chosen:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).toArrow()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
