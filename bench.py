"""Benchmark of the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and forces full execution through the ``noop`` sink
(nothing is collected to the driver).  Prints ONE JSON line:

    {"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "fact_orders", "fact_order_items", "mart_monthly_sales", "mart_category_performance",
    "mart_customer_value", "mart_seller_performance", "geolocation_by_zip", "quality_report",
    "payment_reconciliation", "late_vs_ontime", "repurchase_90d", "category_profile",
    "region_clv_index", "seller_lorenz", "seller_gini", "executive_metrics", "bootstrap_cluster_diff",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    keys = sys.argv[1:] or HEADLINE
    from martlake.session import get_session
    from martlake.plans.catalog import load_all

    spark = get_session(f"local[{cpus}]", app="martlake-bench", shuffle_partitions=int(cpus) * 2,
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    registry = load_all()
    # Warm-up: JVM start, class loading and code generation are not query time.
    registry["mart_monthly_sales"].build(spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for key in keys:
        t0 = time.perf_counter()
        registry[key].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[key] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))


if __name__ == "__main__":
    main()
