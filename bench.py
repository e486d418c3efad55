"""Times the headline queries: BENCH_SF_DIR and BENCH_CPUS choose data and cores.

Each query is run to completion into a sink that discards its rows, once to warm up and
then timed. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

from checks.queries import bound
from tillwork import build_session

HEADLINE = [
    "d4_fact_sales", "d5_run_etl", "r1_monthly_sales", "r2_top_products", "r3_category_rollup",
    "r4_customer_ranking", "r5_quarterly_change", "r6_month_category_oltp", "r7_month_category_dw", "r8_reconcile",
    "q4_sale_detail", "q5_sales_by_customer", "q6_product_ranking", "q7_seller_performance",
    "v16_validate_products_lenient", "v16_validate_clients_lenient", "v23_constraint_audit",
    "c4_check_stock", "c5_price_carts", "c6_validate_carts", "c7_sale_headers", "c9_allocate_stock",
    "c10_cancel_requests", "a3_price_history", "a6_audit_feed", "a7_audit_summary", "a10_top_threats",
    "a12_failure_streaks", "s5_restore",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
                          spark__sql__session__timeZone="UTC", spark__driver__memory="16g",
                          # at test size the fact would fit a broadcast; keep the plan it has at scale
                          spark__sql__autoBroadcastJoinThreshold="1MB",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        for _ in range(2):
            start = time.perf_counter()
            bound(name)(spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
