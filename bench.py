"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default 8) choose data and cores. Each
query runs once to warm the JVM, then ``BENCH_RUNS`` times (default 2); the best time counts.
"""

import json
import os
import time

from pyspark.sql import SparkSession

from suretygraph.plans.catalog import QUERIES

HEADLINE = (
    "daily_risk_metrics",
    "high_volume_accounts",
    "exclude_free_accounts",
    "latest_edges",
    "graph_nodes",
    "cycle_count",
    "cycle_paths",
    "cycle_amounts_by_day",
    "cycle_amounts_by_day_temporal",
    "enriched_vendors_from_attempts",
    "enrichment_counters",
    "save_curated",
    "run_transactions",
    "folded_cycle_counts",
    "folded_cycle_amount_change",
    "merged_graph_counts",
    "merged_outcomes",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("suretygraph-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINE:
        run(name)
        seconds[name] = round(min(run(name) for _ in range(runs)), 3)
    spark.stop()
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }))


if __name__ == "__main__":
    main()
