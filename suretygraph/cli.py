"""``spark-submit`` entry: ``python -m suretygraph.cli JOB --transactions ... --output ...``."""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from suretygraph.plans import jobs
from suretygraph.sinks.graph_store import GraphStore


def main(argv=None) -> None:
    parser = argparse.ArgumentParser(prog="suretygraph")
    parser.add_argument("job", choices=("vendors", "transactions", "graph", "all"))
    parser.add_argument("--process-date", help="YYYY-MM-DD; without it all days are processed")
    parser.add_argument("--transactions", default="data/transactions")
    parser.add_argument("--free-accounts", default="data/free_accounts.csv.gz")
    parser.add_argument("--vendors", default="data/sap_vendors.json")
    parser.add_argument("--output", default="data/curated")
    parser.add_argument("--again", nargs="*", default=[], help="deliveries (YYYY-MM-DD) to take in anew")
    parser.add_argument("--late-days", action="store_true", help="also do days outside the window whose events came since")
    parser.add_argument("--no-listings", action="store_true", help="only count the rings, don't list them")
    parser.add_argument("--attempts", help="Parquet log of lookup attempts")
    parser.add_argument("--merge-attempts", action="store_true", help="the log goes on from those of earlier runs")
    parser.add_argument("--vendor-lines", action="store_true", help="vendors are one JSON object a line")
    parser.add_argument("--graph", help="folder to write the graph to")
    parser.add_argument("--previous-graph", help="graph to merge the window's edges into")
    parser.add_argument("--salt-variable", default="PII_SALT", help="environment variable with the salt")
    args = parser.parse_args(argv)

    paths = jobs.Paths(args.transactions, args.free_accounts, args.vendors, args.output)
    spark = SparkSession.builder.appName(f"suretygraph-{args.job}").getOrCreate()
    if args.job in ("vendors", "all"):
        salt = os.environ.get(args.salt_variable)
        if not salt:
            parser.error(f"set {args.salt_variable}: tax ids are only written as salted hashes")
        attempts = spark.read.parquet(args.attempts) if args.attempts else None
        counters = jobs.run_vendors(
            spark, paths, args.process_date, salt=salt, attempts=attempts, merge=args.merge_attempts, multi_line=not args.vendor_lines)
        if counters is not None:
            counters.show(truncate=False)
    if args.job in ("transactions", "all"):
        jobs.run_transactions(spark, paths, args.process_date, again=args.again, late_days=args.late_days).show(truncate=False)
    if args.job in ("graph", "all"):
        known = args.previous_graph or GraphStore(args.graph or paths.out("graph")).exists(spark)
        jobs.run_graph(
            spark, paths, args.process_date if known else None, graph_path=args.graph, previous_graph=args.previous_graph,
            late_days=args.late_days, listings=not args.no_listings).show(truncate=False)


if __name__ == "__main__":
    main()
