"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores, BENCH_QUERIES (optional) a
comma-separated choice. Each query runs twice and the second run counts, so the numbers show
the plans and not the start of the JVM.
"""

from __future__ import annotations

import json
import os
import pathlib
import sys
import time

ROOT = pathlib.Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

HEADLINE = (
    "gold_monthly_revenue_by_region", "gold_customer_lifetime_value", "gold_top_products", "gold_campaign_performance",
    "gold_client_funnel", "gold_ops_health", "gold_player_daily", "rg_player_flags", "gold_retail_sales_daily",
    "dq_leads", "gate_status", "scd1_stream", "expect_stream", "contract_validate", "ingest_counts",
    "gold_daily_revenue", "payments_vs_orders", "reconcile_retail", "table_digest", "route_decisions",
    "evidence_gate", "sql_running_total", "sql_revenue_having",
)


def main() -> None:
    from tidegate.plans.registry import QUERIES
    from tidegate.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    seconds = {}
    for name in chosen.split(",") if chosen else HEADLINE:
        for _run in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": pathlib.Path(sf_dir).name}))
    spark.stop()


if __name__ == "__main__":
    main()
