"""Re-runnable writers."""

from __future__ import annotations

from collections.abc import Collection
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from suretygraph import schemas
from suretygraph.constants import MAX_ATTEMPTS, WINDOW_DAYS
from suretygraph.operators.graph import graph_nodes, upsert_edges
from suretygraph.operators.quality import window_bounds
from suretygraph.operators.vendors import merge_attempts
from suretygraph.published import Published, Snapshot, placed
from suretygraph.storage import file_names, remove

DAY = "transaction_day"
#: Hash buckets of a table that is merged into, and their number where none was chosen.
BUCKET, BUCKETS = "bucket", 64


def save_by_day(
    rows: DataFrame,
    path: str,
    process_date=None,
    *,
    days: int = WINDOW_DAYS,
    max_records_per_file: int = 0,
    tasks: int | None = None,
    day_parts: int = 1,
    replace_all: bool = False,
) -> None:
    """One folder per ``transaction_day``.

    Rows are rebalanced by day: a small day becomes one file, and a day that holds a large part of the
    rows is split over several tasks and files, each of about the session's advisory partition size.
    Adaptive execution sizes the tasks by bytes, so a load of very many small days may come to few of them;
    ``tasks`` sets their number instead. Days are then dealt out by a hash with a salt of ``day_parts`` values, so
    every day is up to so many files, and a hot day is spread over up to so many tasks.

    A run replaces the days it has rows for and leaves all others alone. A run for a ``process_date`` owns the
    days of its window, so it also removes those it has no rows for (a day whose last row went away must not keep
    its old rows). ``replace_all`` gives up everything stored, and only goes without a date.
    """
    if replace_all and process_date is not None:
        raise ValueError("a run for a date can't replace all days")
    spark = rows.sparkSession
    folders = [] if process_date is None else _window_folders(path, process_date, days)
    before = [file_names(spark, folder) for folder in folders]
    if tasks is None:
        placed = rows.hint("rebalance", DAY)
    else:
        placed = rows.repartition(tasks, F.col(DAY), F.pmod(F.xxhash64(*rows.columns), F.lit(day_parts)))
    (
        placed.write.mode("overwrite")
        .option("maxRecordsPerFile", max_records_per_file)
        .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
        .partitionBy(DAY)
        .parquet(path)
    )
    # A day that still has a file of before was not written by this run.
    for folder, old in zip(folders, before):
        if old & file_names(spark, folder):
            remove(spark, folder)


def _window_folders(path: str, process_date, days: int) -> list[str]:
    first, _ = window_bounds(process_date, days)
    return [f"{path}/{DAY}={first + timedelta(n)}" for n in range(days)]


def save_curated(enriched: DataFrame, path: str, process_date=None, **options) -> None:
    save_by_day(enriched, path, process_date, **options)


def save_edges(edges: DataFrame, path: str, process_date=None, **options) -> None:
    save_by_day(edges, path, process_date, **options)


def save_risk_metrics(metrics: DataFrame, path: str) -> None:
    """Replaced whole: the metrics describe the last run's window."""
    metrics.write.mode("overwrite").parquet(path)


def save_high_volume(accounts: DataFrame, path: str) -> None:
    """Replaced whole, as the metrics."""
    accounts.write.mode("overwrite").parquet(path)


# -- published: written beside what is there, then switched to --------------------------------------


def curated_table(path: str) -> Published:
    return Published(path, schemas.CURATED, (DAY,))


def edge_table(path: str) -> Published:
    return Published(path, schemas.GRAPH_EDGES, (DAY,))


def publish_by_day(
    rows: DataFrame, table: Published, days: Collection[str] | None = None, info: dict | None = None, *, tasks: int | None = None,
    **options,
) -> Snapshot:
    """Publishes rows by ``transaction_day``, rebalanced, or by so many ``tasks``. A run owns the ``days`` it is for
    (YYYY-MM-DD): those it has no rows for go. Without, the days it has rows for are replaced."""
    owned = False if days is None else lambda part: part[DAY] in days
    return table.publish(placed(rows, [DAY], tasks), owned, info, **options)


def publish_risk_metrics(metrics: DataFrame, path: str) -> Snapshot:
    """Replaced whole: the metrics describe the last run's days."""
    return Published(path, schemas.RISK_METRICS).publish(metrics, True)


def publish_high_volume(accounts: DataFrame, path: str) -> Snapshot:
    """Replaced whole, as the metrics."""
    return Published(path, schemas.HIGH_VOLUME_ACCOUNTS).publish(accounts, True)


def publish_whole(rows: DataFrame, path: str, schema: T.StructType) -> Snapshot:
    return Published(path, schema).publish(rows, True)


# -- vendors and graph -----------------------------------------------------------------------------


def run_folder(path: str, run_date: str | None) -> str:
    return f"{path}/day={run_date[:10] if run_date else 'unknown'}"


def save_vendors_json(vendors: DataFrame, path: str, run_date: str | None = None) -> None:
    """JSON lines in the run date's folder (``day=unknown`` without one), replaced whole. Nulls are kept."""
    folder = run_folder(path, run_date)
    vendors.write.mode("overwrite").option("ignoreNullFields", False).json(folder)


def save_vendors(vendors: DataFrame, path: str, run_date: str | None = None) -> None:
    """Parquet in the run date's folder, apart from the JSON: one root holds one format."""
    vendors.write.mode("overwrite").parquet(run_folder(path, run_date))


def save_outcomes(outcomes: DataFrame, path: str, run_date: str | None = None) -> None:
    """One row for each vendor of the run's attempt log."""
    outcomes.write.mode("overwrite").parquet(run_folder(path, run_date))


def attempt_table(path: str) -> Published:
    """Each vendor's earliest attempts, in buckets by a hash of the vendor."""
    return Published(path, T.StructType([*schemas.ATTEMPTS.fields, T.StructField(BUCKET, T.IntegerType())]), (BUCKET,))


def publish_attempts(log: DataFrame, path: str, max_attempts: int = MAX_ATTEMPTS, buckets: int = BUCKETS) -> Snapshot:
    """Merges a log into the stored attempts. Only the buckets of its vendors are read and rewritten; their numbers come to the
    driver."""
    spark, table = log.sparkSession, attempt_table(path)
    before = table.snapshot(spark)
    n = before.info.get("buckets", buckets)
    bucket = F.pmod(F.xxhash64("vendor_id"), F.lit(n)).cast("int")
    fresh = log.select(*schemas.ATTEMPTS.names)
    touched = {r[0] for r in fresh.select(bucket.alias(BUCKET)).distinct().collect()}
    mine = lambda part: int(part[BUCKET]) in touched
    merged = merge_attempts(table.scan(spark, mine, before).drop(BUCKET), fresh, max_attempts)
    return table.publish(merged.withColumn(BUCKET, bucket).hint("rebalance", BUCKET), mine, {"buckets": n})


def save_graph(incoming: DataFrame, path: str, existing: DataFrame | None = None) -> None:
    """Writes plain folders ``path/edges`` and ``path/nodes``: the stored edges, if any, with the new ones merged in. For a graph
    that is merged into time and again see ``graph_store``.

    ``path`` must be another folder than the one ``existing`` is read from; readers switch afterwards.
    Nodes come from the edges just written, not from a second merge.
    """
    spark = incoming.sparkSession
    stored = incoming.limit(0) if existing is None else existing
    upsert_edges(stored, incoming).write.mode("overwrite").parquet(f"{path}/edges")
    graph_nodes(spark.read.parquet(f"{path}/edges")).write.mode("overwrite").parquet(f"{path}/nodes")
