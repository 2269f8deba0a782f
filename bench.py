"""Headline queries end to end; prints one JSON line with seconds per query.

Every query starts from the raw parquet tables and runs through bronze, silver and
gold; its full result is produced (Spark's ``noop`` sink) but not collected.
Each figure is the best of ``BENCH_RUNS`` runs after one shared warm-up.
"""

from __future__ import annotations

import json
import os
import time

from silverlode.session import build_session
from workload.queries import run

HEADLINES = (
    "latest_status", "silver_orders", "silver_order_items", "dim_date", "dim_customers",
    "dim_products_named", "fact_order_items", "fact_orders", "daily_sales_summary",
    "product_performance", "return_rate_by_reason", "delivery_performance", "dash_kpis",
    "dash_top_products", "dash_categories", "dq_bronze", "dq_orphans", "insert_if_absent",
    "upsert_manifest", "taxi_stage", "taxi_dedup", "taxi_clean", "taxi_dq", "fx_flatten",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    run("daily_sales_summary", spark, folder).write.format("noop").mode("overwrite").save()

    seconds: dict[str, float] = {}
    for name in HEADLINES:
        best = float("inf")
        for _ in range(runs):
            started = time.perf_counter()
            run(name, spark, folder).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - started)
        seconds[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
