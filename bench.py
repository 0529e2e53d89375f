"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3).
The median of the runs counts, so the first and cold one does not decide. Every run
builds the query from the raw tables and computes all rows and columns of its result.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from marketloom import catalog
from marketloom.session import drop_scratch, local_session

HEADLINE = (
    "stg_orders",
    "stg_order_items",
    "stg_products",
    "stg_marketing_leads",
    "stg_geolocation",
    "stg_geolocation_exact",
    "dim_geography",
    "dim_customer",
    "fact_orders",
    "fact_order_items",
    "fact_payments",
    "mart_monthly_revenue",
    "mart_customer_lifetime_value",
    "mart_geo_performance",
    "mart_seller_performance",
    "mart_marketing_funnel",
    "mart_logistics_performance",
    "mart_product_performance",
    "product_aggregate",
    "repeat_buyers",
    "global_ntile_customers",
    "running_revenue_share",
    "merge_geo_by_key",
    "append_new_orders",
    "dq_core_suite",
    "dq_geo_suite",
    "report_rfm_segments",
    "report_top_categories",
    "report_seller_lorenz",
    "report_delivery_histogram",
    "report_business_summary",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    seconds: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken), 3)
    print(
        json.dumps(
            {
                "metric": "total median wall time of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )
    drop_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
