"""Benchmark: pipeline + headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

``pipeline`` is the full run from the test tables to the written gold star
(fixture mapping, bronze, dedupe, validation and quarantine, dimensions,
calendar, partitioned and clustered fact).  Every other entry is one
registered query over the stored lake, executed to completion with the
``noop`` sink (no collect to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "bm01_total_revenue", "bm02_monthly_growth", "bm03_avg_order_value", "bm04_top_months",
    "bm05_revenue_by_category", "bm06_top_profit_products", "bm07_declining_products", "bm08_revenue_by_store",
    "bm09_top_margin_stores", "bm10_region_revenue_per_store", "bm11_revenue_by_segment",
    "bm12_repeat_customer_rate", "bm13_avg_customer_value", "bm14_cancellation_rate", "bm15_return_rate",
    "bm16_payment_failure_rate", "month_slice_kpis", "kpi_overview", "repeat_customer_ratio",
    "sales_sliced", "yoy_sales", "mom_growth_gap_aware", "customer_revenue_histogram", "star_wide",
    "dq_summary", "rejection_summary", "fact_sales",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "4"))
    from lakemart.plans import queries as Q
    from lakemart.plans.pipeline import fixture_lake
    from lakemart.session import build_session

    # spark.checkpoint.dir comes from the session (set only when unset)
    spark = build_session(f"local[{cpus}]", "lakemart-bench", shuffle_partitions=max(8, 2 * cpus))

    times: dict[str, float] = {}
    t0 = time.perf_counter()
    fixture_lake(spark, sf_dir, reuse=False)  # always a full, fresh pipeline run
    times["pipeline"] = round(time.perf_counter() - t0, 3)
    for name in HEADLINE:
        t = time.perf_counter()
        Q.run(name, spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t, 3)
    total = round(sum(times.values()), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_sec", "value": total, "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
