"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from tradeflow.plans.registry import QUERIES  # noqa: E402
from tradeflow.session import build_session  # noqa: E402

HEADLINES = (
    "clean_orders",
    "quarantine_orders",
    "route_orders",
    "clean_inventory",
    "quarantine_price_events",
    "daily_revenue",
    "sales_velocity",
    "inventory_risk",
    "price_anomalies",
    "kpi_summary",
    "revenue_pivot",
    "serve_daily_revenue",
    "quarantine_summary",
    "reconciliation",
    "upsert",
    "as_of",
    "expire",
    "compact",
    "cluster_by_z",
    "ingest_orders",
    "full_run",
)

# Untimed, so that the first timed query does not pay for starting the JVM and compiling its hot code.
WARM_UP = ("quarantine_orders", "inventory_risk", "as_of")


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINES
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in WARM_UP:
        run(spark, name, sf_dir)
    seconds = {name: run(spark, name, sf_dir) for name in names}
    line = {
        "metric": "headline queries, wall clock",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
