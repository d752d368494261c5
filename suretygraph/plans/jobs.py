"""The three jobs and their sequence."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from suretygraph.constants import DOMAIN_KEYWORDS, MAX_ATTEMPTS, WINDOW_DAYS
from suretygraph.operators import exclusion, graph, quality, rings, risk, vendors
from suretygraph.plans.counters import TransactionCounters
from suretygraph.schemas import PATH_COUNT, RING_CHANGES, RING_PATHS
from suretygraph.sinks import parquet as sink
from suretygraph.sinks.graph_store import BUCKETS, GraphStore
from suretygraph.sources import files


@dataclass(frozen=True)
class Paths:
    """Where the jobs read and write. Folders below ``output`` carry the tables' names."""

    transactions: str
    free_accounts: str
    vendors: str
    output: str

    def out(self, table: str) -> str:
        return f"{self.output}/{table}"


def scored_transactions(
    transactions: DataFrame, free_accounts: DataFrame | None, *, processed_at=None, counters: TransactionCounters | None = None
) -> DataFrame:
    """Validated, approved and scored; promotional accounts dropped unless ``free_accounts`` is None. ``counters`` watches."""
    def seen(step: str, rows: DataFrame) -> DataFrame:
        return rows if counters is None else getattr(counters, step)(rows)

    unique = seen("unique", quality.dedup_transactions(seen("read", transactions)))
    kept = seen("approved", quality.approved_transactions(seen("valid", quality.valid_rows(unique))))
    if free_accounts is not None:
        kept = exclusion.exclude_free_accounts(kept, exclusion.exclusion_list(free_accounts))
    return seen("written", risk.enrich_transactions(kept, processed_at=processed_at))


def run_transactions(
    spark: SparkSession,
    paths: Paths,
    process_date=None,
    *,
    again: Iterable[str] = (),
    late_days: bool = False,
    tasks: int | None = None,
    processed_at=None,
) -> DataFrame:
    """Takes new files in, then publishes curated transactions, metrics, high-volume accounts and edges, and the delivered
    lines that don't fit the schema. Returns the run's counters, as one row, which is published too.

    A window is read from what was taken in, by the event's day: of all deliveries, but only of its days. ``again``
    names deliveries to take in anew. With ``late_days`` a run for a date also does the days outside its window whose events
    came, or were replaced, since the last run that did (or that had no date). Metrics, accounts and edges come from the
    curated days just written, each only its own columns. Nothing is cached: what they need is on storage and outlives a
    lost executor. ``tasks`` sets the number of writers by day, for a first load of years. A run that dies leaves the tables it hasn't published yet as they were; the next one does its days again.
    """
    intake = paths.out("intake")
    taken = files.take_in(spark, paths.transactions, intake, again, paths.out("rejected_lines"), tasks)
    curated, edges = sink.curated_table(paths.out("transactions")), sink.edge_table(paths.out("graph_edges"))
    at = files.intake_rows(intake).snapshot(spark).number
    days, note = None, {"intake": at}
    if process_date is not None:
        days = files.window_days(process_date)
        if late_days:
            days |= files.days_changed(spark, intake, edges.snapshot(spark).info.get("intake", 0))
        else:
            note = None
    counters = TransactionCounters(taken.files, taken.lines, taken.rejected)
    enriched = scored_transactions(
        files.scan_taken_in(spark, intake, wanted=days), files.scan_free_accounts(spark, paths.free_accounts),
        processed_at=processed_at, counters=counters)
    sink.publish_by_day(enriched, curated, days, tasks=tasks)

    written = files.scan_curated(spark, paths.out("transactions"), wanted=days)
    sink.publish_risk_metrics(risk.daily_risk_metrics(written), paths.out("risk_metrics"))
    sink.publish_high_volume(risk.high_volume_accounts(written), paths.out("high_risk_accounts"))
    # The last of the day tables notes how far the run has come: one that died before is made up for by the next.
    sink.publish_by_day(graph.graph_edges(written), edges, days, note, tasks=tasks)
    row = counters.row(spark)
    sink.publish_whole(row, paths.out("transaction_counters"), row.schema)
    return row


def run_vendors(
    spark: SparkSession,
    paths: Paths,
    run_date: str | None = None,
    *,
    salt: str,
    attempts: DataFrame | None = None,
    merge: bool = False,
    keywords=DOMAIN_KEYWORDS,
    multi_line: bool = True,
    max_attempts: int = MAX_ATTEMPTS,
    processed_at=None,
) -> DataFrame | None:
    """Writes the enriched vendors as JSON and as Parquet.

    Domains come from the log of lookup attempts if there is one (a table with ``vendor_id``,
    ``status_code``, ``response_body`` and either ``attempt`` or ``attempted_at`` and ``attempt_id``),
    else from the keywords. With a log its outcomes are stored, and the run's counters are returned, as one row. With ``merge``
    the log is a further part of one that goes on: it is merged into the earliest attempts of each vendor that earlier runs
    stored, and the outcomes are those of all parts, none of which is read again. Such a log has ``attempted_at`` and ``attempt_id``.
    """
    records = files.scan_vendors(spark, paths.vendors, multi_line=multi_line)
    counters = None
    if attempts is None:
        resolved = vendors.resolve_vendor_domain(records, keywords=keywords)
    else:
        if merge:
            sink.publish_attempts(attempts, paths.out("vendor_attempts"), max_attempts)
            attempts = sink.attempt_table(paths.out("vendor_attempts")).scan(spark)
        numbered = attempts if "attempt" in attempts.columns else vendors.number_attempts(attempts, max_attempts)
        sink.save_outcomes(vendors.vendor_outcome(numbered, max_attempts=max_attempts), paths.out("vendor_outcomes"), run_date)
        outcomes = files.scan_outcomes(spark, paths.out("vendor_outcomes"), run_date)
        resolved = vendors.domains_from_outcomes(records, outcomes)
        counters = vendors.enrichment_counters(outcomes)
    enriched = vendors.enriched_vendors(resolved, salt=salt, run_date=run_date, processed_at=processed_at)
    sink.save_vendors(enriched, paths.out("enriched_vendors"), run_date)
    # The JSON copy repeats what was stored, hash and time of the run included.
    sink.save_vendors_json(
        files.scan_enriched_vendors(spark, paths.out("enriched_vendors"), run_date),
        paths.out("enriched_vendors_json"),
        run_date,
    )
    return counters


def run_graph(
    spark: SparkSession,
    paths: Paths,
    process_date=None,
    *,
    graph_path: str | None = None,
    previous_graph: str | None = None,
    days: int = WINDOW_DAYS,
    late_days: bool = False,
    listings: bool = True,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Merges stored edges into the graph and counts its rings of two and three accounts.

    Without a date the graph is built anew of all stored edges, or of those and ``previous_graph``. With one, the window's edges
    are merged into the graph at ``graph_path``, which stays readable meanwhile, or with ``previous_graph`` into a new one. A
    merge reads and writes only the buckets it touches, and the rings are counted by the difference it makes. With
    ``late_days`` the days whose stored edges changed since the last such run, or the last without a date, are merged too. An
    edge that a corrected window no longer offers stays in the merged graph; only a graph built anew lacks it.

    ``listings`` also publishes the rings (``ring_paths``) and the change of the amounts on them from day to day
    (``ring_changes``), of the latest edges. Returns, lazily, a row for ``edge_count`` (edges offered) and one for ``cycle_count``
    (closed paths in the graph).
    """
    target = graph_path or paths.out("graph")
    if previous_graph is not None and previous_graph.rstrip("/") == target.rstrip("/"):
        raise ValueError("a graph is merged into itself without naming it as the previous one")
    store, stored_edges = GraphStore(target, buckets), sink.edge_table(paths.out("graph_edges"))
    at = stored_edges.snapshot(spark).number
    if process_date is None:
        offered, note = files.scan_edges(spark, paths.out("graph_edges")), {"edges": at}
    else:
        if previous_graph is None and not store.exists(spark):
            raise ValueError("a window of edges is only part of a graph: name the previous one, or build one of all edges")
        first, last = quality.window_bounds(process_date, days)
        offered, note = files.scan_edges(spark, paths.out("graph_edges"), first, last), None
        if late_days:
            window = files.window_days(process_date, days)
            late = {p["transaction_day"] for p in stored_edges.changed(spark, store.info(spark).get("edges", 0))} - window
            offered = offered.unionByName(stored_edges.scan(spark, lambda part: part["transaction_day"] in late))
            note = {"edges": at}
    if previous_graph is not None:
        store.build(graph.upsert_edges(files.scan_edges(spark, f"{previous_graph}/edges"), offered), note)
    elif process_date is None:
        store.build(offered, note)
    else:
        store.merge(offered, note)
    if listings:
        paths_found, changes = rings.latest_listings(store.edges(spark))
        sink.publish_whole(paths_found, f"{target}/ring_paths", RING_PATHS)
        sink.publish_whole(changes, f"{target}/ring_changes", RING_CHANGES)
    edge_row = graph.edge_count(offered).select(F.lit("edge_count").alias("measure"), F.col("edge_count").cast(PATH_COUNT).alias("value"))
    cycle_row = spark.createDataFrame([("cycle_count", Decimal(store.cycle_count(spark)))], edge_row.schema)
    return edge_row.unionByName(cycle_row)


def run_all(
    spark: SparkSession,
    paths: Paths,
    run_date: str,
    *,
    salt: str,
    attempts: DataFrame | None = None,
    multi_line: bool = True,
    graph_path: str | None = None,
    previous_graph: str | None = None,
    again: Iterable[str] = (),
    late_days: bool = False,
    listings: bool = True,
    processed_at=None,
) -> tuple[DataFrame, DataFrame | None]:
    """Vendors, transactions and graph for one run date. Returns the graph job's counts and the vendors' counters.

    The window's edges are merged into the graph that is there, or with ``previous_graph`` into a new one. Without either the
    graph is built of all stored edges.
    """
    counters = run_vendors(
        spark, paths, run_date, salt=salt, attempts=attempts, multi_line=multi_line, processed_at=processed_at)
    run_transactions(spark, paths, run_date[:10], again=again, late_days=late_days, processed_at=processed_at)
    known = previous_graph is not None or GraphStore(graph_path or paths.out("graph")).exists(spark)
    counts = run_graph(
        spark, paths, run_date[:10] if known else None, graph_path=graph_path, previous_graph=previous_graph,
        late_days=late_days, listings=listings)
    return counts, counters
