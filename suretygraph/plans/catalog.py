"""The registered queries: every operator over the whole benchmark tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from suretygraph import schemas
from suretygraph.operators import exclusion, graph, quality, ring_change, rings, risk, vendors
from suretygraph.plans import jobs
from suretygraph.published import Published
from suretygraph.sinks import parquet as sink
from suretygraph.sinks.graph_store import GraphStore
from suretygraph.storage import shuffles_go
from suretygraph.storage import staging_folder as staging
from suretygraph.sources import files, tables

PROCESS_DATE = "1998-06-30"
RUN_DATE = "1998-06-30"
AGAIN_FROM = "1996-01-01"
PROCESSED_AT = datetime(1998, 7, 1, 12, 30)
SALT = "benchmark-salt"
#: Days of the folded edges that come to a graph one after the other; they overlap.
FOLDED_SPANS = (("1998-01-01", "1998-01-25"), ("1998-01-15", "1998-02-05"), ("1998-02-01", "1998-02-28"))

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# -- stages shared by the queries ------------------------------------------------------------------


def _transactions(spark, sf_dir) -> DataFrame:
    return quality.transaction_day(tables.transactions(spark, sf_dir))


def _valid(spark, sf_dir) -> DataFrame:
    return quality.validate_data_quality(_transactions(spark, sf_dir))


def _approved(spark, sf_dir) -> DataFrame:
    return quality.approved_transactions(_valid(spark, sf_dir))


def _excluded(spark, sf_dir) -> DataFrame:
    return exclusion.exclusion_list(tables.free_accounts(spark, sf_dir))


def _clean(spark, sf_dir) -> DataFrame:
    return exclusion.exclude_free_accounts(_approved(spark, sf_dir), _excluded(spark, sf_dir))


def _enriched(spark, sf_dir) -> DataFrame:
    return risk.enrich_transactions(_clean(spark, sf_dir))


def _edges(spark, sf_dir, exclude_promotional: bool = True) -> DataFrame:
    return graph.graph_edges((_clean if exclude_promotional else _approved)(spark, sf_dir))


def _outcomes(spark, sf_dir) -> DataFrame:
    return vendors.vendor_outcome(vendors.number_attempts(tables.attempt_log(spark, sf_dir)))


def _money(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def _amounts(df: DataFrame) -> DataFrame:
    return _money(df, "guarantee_amount_usd", "fee_amount_usd")


def _whole(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.col(column).cast("long"))


# -- transactions ----------------------------------------------------------------------------------


@query
def transaction_day(spark, sf_dir):
    return _amounts(_transactions(spark, sf_dir))


@query
def incremental_window(spark, sf_dir):
    return _amounts(quality.incremental_window(_transactions(spark, sf_dir), PROCESS_DATE))


@query
def dedup_transactions(spark, sf_dir):
    return _amounts(quality.dedup_transactions(_transactions(spark, sf_dir)))


@query
def validate_data_quality(spark, sf_dir):
    return _amounts(_valid(spark, sf_dir))


@query
def approved_transactions(spark, sf_dir):
    return _amounts(_approved(spark, sf_dir))


@query
def qualifying_free_accounts(spark, sf_dir):
    return exclusion.qualifying_free_accounts(tables.free_accounts(spark, sf_dir))


@query
def exclude_free_source(spark, sf_dir):
    return _amounts(exclusion.exclude_free_source(_approved(spark, sf_dir), _excluded(spark, sf_dir)))


@query
def exclude_free_accounts(spark, sf_dir):
    return _amounts(_clean(spark, sf_dir))


@query
def enrich_transactions(spark, sf_dir):
    scored = risk.enrich_transactions(_clean(spark, sf_dir), processed_at=PROCESSED_AT)
    return _amounts(scored.withColumn("processed_at", F.date_format("processed_at", "yyyy-MM-dd HH:mm:ss")))


@query
def daily_risk_metrics(spark, sf_dir):
    return risk.daily_risk_metrics(_enriched(spark, sf_dir))


@query
def high_volume_accounts(spark, sf_dir):
    return risk.high_volume_accounts(_enriched(spark, sf_dir))


# -- graph -----------------------------------------------------------------------------------------


@query
def graph_edges(spark, sf_dir):
    return _money(_edges(spark, sf_dir), "guarantee_amount_usd")


@query
def graph_edges_export(spark, sf_dir):
    return graph.graph_edges_export(_edges(spark, sf_dir))


@query
def edge_count(spark, sf_dir):
    return graph.edge_count(_edges(spark, sf_dir))


@query
def graph_nodes(spark, sf_dir):
    return graph.graph_nodes(_edges(spark, sf_dir))


@query
def latest_edges(spark, sf_dir):
    return _money(graph.latest_edges(_edges(spark, sf_dir)), "guarantee_amount_usd")


@query
def upsert_edges(spark, sf_dir):
    """Edges up to a day are stored; those of the years before it and after come in, with smaller amounts."""
    edges = _edges(spark, sf_dir)
    day = F.col("transaction_day")
    incoming = edges.filter(day >= F.lit(AGAIN_FROM).cast("date")).withColumn(
        "guarantee_amount_usd", (F.col("guarantee_amount_usd") / 2).cast(schemas.MONEY))
    merged = graph.upsert_edges(edges.filter(day <= F.lit(PROCESS_DATE).cast("date")), incoming)
    return _money(merged, "guarantee_amount_usd")


def _paths(edges: DataFrame, mode: str, min_len: int, max_len: int) -> DataFrame:
    listed = rings.cycle_paths(edges, mode=mode, min_len=min_len, max_len=max_len)
    return _whole(listed.drop("nodes"), "path_count")


@query
def rings_len2(spark, sf_dir):
    return _paths(_edges(spark, sf_dir), "latest", 2, 2)


@query
def rings_len3(spark, sf_dir):
    return _paths(_edges(spark, sf_dir), "latest", 3, 3)


@query
def cycle_count(spark, sf_dir):
    return _whole(rings.cycle_count(_edges(spark, sf_dir)), "cycle_count")


@query
def cycle_count_before_exclusion(spark, sf_dir):
    return _whole(rings.cycle_count(_edges(spark, sf_dir, exclude_promotional=False)), "cycle_count")


@query
def cycle_count_temporal(spark, sf_dir):
    return _whole(rings.cycle_count(_edges(spark, sf_dir), mode="temporal", min_len=1), "cycle_count")


@query
def cycle_paths(spark, sf_dir):
    """The printed query: paths of one to three edges, with the day and amount of each edge."""
    listed = rings.cycle_path_edges(_edges(spark, sf_dir))
    day_texts = F.transform("edges", lambda e: e["transaction_day"].cast("string"))
    amounts = F.transform("edges", lambda e: e["guarantee_amount_usd"].cast("string"))
    return listed.select(
        "account",
        "cycle_length",
        "path",
        F.concat_ws(">", day_texts).alias("days"),
        F.concat_ws(">", amounts).alias("amounts"),
    )


@query
def cycle_paths_temporal(spark, sf_dir):
    return _paths(_edges(spark, sf_dir), "temporal", 1, 3)


@query
def cycle_amounts_by_day(spark, sf_dir):
    return _money(rings.cycle_amounts_by_day(_edges(spark, sf_dir)), "total_amount")


@query
def cycle_amounts_by_day_temporal(spark, sf_dir):
    return _money(rings.cycle_amounts_by_day(_edges(spark, sf_dir), mode="temporal"), "total_amount")


@query
def cycle_amounts_before_exclusion(spark, sf_dir):
    edges = _edges(spark, sf_dir, exclude_promotional=False)
    return _money(rings.cycle_amounts_by_day(edges, mode="temporal"), "total_amount")


@query
def cycle_amount_change(spark, sf_dir):
    changes = rings.cycle_amount_change(_edges(spark, sf_dir), mode="temporal")
    return _money(changes, "total_amount", "previous_amount", "change")


def _folded(spark, sf_dir) -> DataFrame:
    """Edges of all lines among fewer accounts: pairs have a few parallel edges, and every account is on several rings."""
    lines = tables.table(spark, sf_dir, "lineitem")
    fold = max(40, lines.count() // 15)
    source = F.col("l_orderkey") % fold
    name = lambda x: F.concat(F.lit("F_"), F.pmod(x, F.lit(fold)))
    return lines.select(
        name(source).alias("source_account_id"), name(source + F.col("l_partkey") % 5 - 2).alias("target_account_id"),
        F.col("l_extendedprice").cast(schemas.MONEY).alias("guarantee_amount_usd"),
        F.date_add(F.lit("1998-01-01").cast("date"), F.col("l_quantity").cast("int")).alias("transaction_day"),
    )


@query
def folded_cycle_counts(spark, sf_dir):
    return _whole(rings.cycle_counts(_folded(spark, sf_dir), min_len=1), "cycle_count")


@query
def folded_cycle_paths(spark, sf_dir):
    edges = _folded(spark, sf_dir)
    return reduce(DataFrame.unionByName, [_paths(edges, mode, 1, 3).withColumn("mode", F.lit(mode)) for mode in rings.MODES])


@query
def folded_cycle_amount_change(spark, sf_dir):
    return _money(rings.cycle_amount_changes(_folded(spark, sf_dir)), "total_amount", "previous_amount", "change")


def _day(text: str) -> Column:
    return F.lit(text).cast("date")


@query
def cycle_count_change(spark, sf_dir):
    """Rings gained and lost between two overlapping spans of days."""
    edges = _folded(spark, sf_dir)
    before = edges.filter(F.col("transaction_day") <= _day(FOLDED_SPANS[0][1]))
    after = edges.filter(F.col("transaction_day") >= _day(FOLDED_SPANS[1][0]))
    return reduce(DataFrame.unionByName, [
        _whole(ring_change.cycle_count_change(ring_change.near_changes(ring_change.pair_changes(before, after, mode)), mode=mode, min_len=1), "cycle_count_change")
        .withColumn("mode", F.lit(mode)) for mode in rings.MODES])


def _merged_store(spark, sf_dir, each=lambda store: None) -> GraphStore:
    """A graph of the first span of days, the others merged in, each with other amounts than the one before."""
    store = GraphStore(staging(spark), buckets=8)
    edges = _folded(spark, sf_dir)
    for k, (first, last) in enumerate(FOLDED_SPANS):
        span = edges.filter(F.col("transaction_day").between(_day(first), _day(last)))
        folder = staging(spark)
        span.withColumn("guarantee_amount_usd", (F.col("guarantee_amount_usd") + k).cast(schemas.MONEY)).write.parquet(folder)
        offered = spark.read.schema(schemas.GRAPH_EDGES).parquet(folder)
        (store.merge if k else store.build)(offered)
        each(store)
    return store


@query
def merged_graph_edges(spark, sf_dir):
    return _money(_merged_store(spark, sf_dir).edges(spark), "guarantee_amount_usd")


@query
def merged_graph_nodes(spark, sf_dir):
    return _merged_store(spark, sf_dir).nodes(spark)


@query
def merged_graph_counts(spark, sf_dir):
    """The noted number of rings after each merge, kept up by differences."""
    counts = []
    _merged_store(spark, sf_dir, lambda store: counts.append((len(counts), store.cycle_count(spark))))
    return spark.createDataFrame(counts, "step long, cycle_count long")


def _graph_job(spark, sf_dir) -> GraphStore:
    """The graph job on all days before a window, then on the window, merged into the same graph."""
    paths = jobs.Paths("", "", "", staging(spark))
    edges, table = _folded(spark, sf_dir), sink.edge_table(paths.out("graph_edges"))
    sink.publish_by_day(edges.filter(F.col("transaction_day") < _day("1998-01-22")), table)
    jobs.run_graph(spark, paths, listings=False, buckets=8)
    sink.publish_by_day(edges, table)
    jobs.run_graph(spark, paths, "1998-02-20", days=30)
    return GraphStore(paths.out("graph"))


@query
def run_graph_edges(spark, sf_dir):
    return _money(_graph_job(spark, sf_dir).edges(spark), "guarantee_amount_usd")


@query
def run_graph_ring_paths(spark, sf_dir):
    path = f"{_graph_job(spark, sf_dir).path}/ring_paths"
    return _whole(Published(path, schemas.RING_PATHS).scan(spark), "path_count")


@query
def run_graph_ring_changes(spark, sf_dir):
    path = f"{_graph_job(spark, sf_dir).path}/ring_changes"
    return _money(Published(path, schemas.RING_CHANGES).scan(spark), "total_amount", "previous_amount", "change")


# -- vendors ---------------------------------------------------------------------------------------


@query
def resolve_vendor_domain(spark, sf_dir):
    resolved = vendors.resolve_vendor_domain(tables.vendors(spark, sf_dir), keywords=tables.KEYWORDS)
    return resolved.select("vendor_id", "legal_name", "domain")


@query
def hash_tax_id(spark, sf_dir):
    return vendors.hashed_tax_ids(tables.vendors(spark, sf_dir), salt=SALT)


@query
def enriched_vendors(spark, sf_dir):
    resolved = vendors.resolve_vendor_domain(tables.vendors(spark, sf_dir), keywords=tables.KEYWORDS)
    return vendors.enriched_vendors(resolved, salt=SALT, run_date=RUN_DATE).drop("processed_at")


@query
def enriched_vendors_from_attempts(spark, sf_dir):
    resolved = vendors.domains_from_outcomes(tables.vendors(spark, sf_dir), _outcomes(spark, sf_dir))
    return vendors.enriched_vendors(resolved, salt=SALT, run_date=RUN_DATE).drop("processed_at")


@query
def attempt_class(spark, sf_dir):
    log = tables.attempt_log(spark, sf_dir).select("vendor_id", "attempt_id", "status_code")
    return vendors.classify_attempts(log)


@query
def response_domain(spark, sf_dir):
    log = tables.attempt_log(spark, sf_dir).select("vendor_id", "attempt_id", "response_body")
    return vendors.attempt_domains(log).drop("response_body")


@query
def vendor_outcome(spark, sf_dir):
    return _outcomes(spark, sf_dir)


@query
def merged_outcomes(spark, sf_dir):
    """The log in three parts, in no order of time, each merged into what was stored; one part comes twice."""
    root, log = staging(spark), tables.attempt_log(spark, sf_dir)
    for part in (1, 0, 2, 0):
        sink.publish_attempts(log.filter(F.col("attempt_id") % 3 == part), root, buckets=4)
    stored = sink.attempt_table(root).scan(spark)
    return vendors.vendor_outcome(vendors.number_attempts(stored))


@query
def enrichment_counters(spark, sf_dir):
    return vendors.enrichment_counters(_outcomes(spark, sf_dir))


# -- files: written from the tables by Spark, then read through the scans ---------------------------


def _tasks(spark) -> int:
    """Writers of a whole history at once: years of days, each small next to a window's."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _stage_transactions(spark, sf_dir) -> str:
    """Transaction CSVs, one delivery folder per month: the event's own time decides its day."""
    root = staging(spark)
    (
        tables.transactions(spark, sf_dir)
        .withColumn("day", F.trunc("timestamp", "month"))
        .hint("rebalance", "day")
        .write.option("header", True)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .partitionBy("day")
        .csv(root)
    )
    return root


def _stage_free_accounts(spark, sf_dir) -> str:
    root = staging(spark)
    accounts = tables.free_accounts(spark, sf_dir)
    accounts.write.option("header", True).option("compression", "gzip").csv(root)
    return root


def _stage_vendors(spark, sf_dir) -> str:
    root = staging(spark)
    tables.vendors(spark, sf_dir).write.json(root)
    return root


@query
def scan_transactions(spark, sf_dir):
    return _amounts(files.scan_transactions(spark, _stage_transactions(spark, sf_dir)))


def _deliver(rows: DataFrame, root: str, mode: str = "append") -> None:
    """Writes rows into their months' delivery folders, in gzip files of their own; the rebalanced tasks bound their length."""
    placed = rows.withColumn("day", F.trunc("timestamp", "month")).hint("rebalance", "day")
    with shuffles_go(rows.sparkSession):
        (
            placed.write.mode(mode).option("partitionOverwriteMode", "dynamic").option("header", True).option("compression", "gzip")
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").partitionBy("day").csv(root)
        )


def _half(rows: DataFrame, k: int) -> DataFrame:
    return rows.filter(F.length("target_account_id") % 2 == k)


@query
def take_in_grown(spark, sf_dir):
    """Half of each month's rows is delivered and taken in; then the deliveries grow by the other half."""
    root, store = staging(spark), staging(spark)
    rows = tables.transactions(spark, sf_dir)
    for k in (0, 1):
        _deliver(_half(rows, k), root)
        files.take_in(spark, root, store, tasks=_tasks(spark))
    return _amounts(files.scan_taken_in(spark, store))


@query
def take_in_replaced(spark, sf_dir):
    """Later months are delivered again, with other amounts."""
    root, store = staging(spark), staging(spark)
    rows = tables.transactions(spark, sf_dir)
    _deliver(rows, root)
    files.take_in(spark, root, store, tasks=_tasks(spark))
    more = (F.col("guarantee_amount_usd") + 1).cast(schemas.MONEY)
    _deliver(rows.filter(F.col("timestamp") >= F.lit(AGAIN_FROM).cast("date")).withColumn("guarantee_amount_usd", more), root, "overwrite")
    files.take_in(spark, root, store, tasks=_tasks(spark))
    return _amounts(files.scan_taken_in(spark, store))


@query
def rejected_by_delivery(spark, sf_dir):
    """Lines with an amount that is no number, taken in by two deliveries' worth of files each."""
    root, store = staging(spark), staging(spark)
    rows = tables.transactions(spark, sf_dir)
    amount = F.when(F.col("fee_amount_usd") < 0, F.lit("n/a")).otherwise(F.col("guarantee_amount_usd").cast("string"))
    for k in (0, 1):
        _deliver(_half(rows, k).withColumn("guarantee_amount_usd", amount), root)
        files.take_in(spark, root, store, rejected_path=f"{store}/rejected", tasks=_tasks(spark))
    return files.scan_rejected(spark, f"{store}/rejected").groupBy("delivery").agg(F.count("*").alias("n_lines"))


@query
def scan_free_accounts(spark, sf_dir):
    return files.scan_free_accounts(spark, _stage_free_accounts(spark, sf_dir))


@query
def scan_vendors(spark, sf_dir):
    return files.scan_vendors(spark, _stage_vendors(spark, sf_dir), multi_line=False)


@query
def scan_vendors_array(spark, sf_dir):
    """JSON arrays, one a file."""
    root = staging(spark)
    record = F.struct(*schemas.VENDORS.names)
    part = F.pmod(F.xxhash64("vendor_id"), F.lit(4)).alias("part")
    arrays = tables.vendors(spark, sf_dir).groupBy(part).agg(F.to_json(F.collect_list(record)).alias("value"))
    arrays.write.partitionBy("part").text(root)
    return files.scan_vendors(spark, f"{root}/part=*")


@query
def scan_edges(spark, sf_dir):
    """A range of days, pruned to their folders."""
    root = staging(spark)
    sink.save_edges(_edges(spark, sf_dir), root, tasks=_tasks(spark))
    return _money(files.scan_edges(spark, root, "1994-01-01", "1996-12-31"), "guarantee_amount_usd")


@query
def save_curated(spark, sf_dir):
    root = staging(spark)
    sink.save_curated(_enriched(spark, sf_dir), root, tasks=_tasks(spark))
    return _amounts(files.scan_curated(spark, root).drop("processed_at"))


@query
def save_risk_metrics(spark, sf_dir):
    root = staging(spark)
    sink.save_risk_metrics(risk.daily_risk_metrics(_enriched(spark, sf_dir)), root)
    return spark.read.parquet(root)


@query
def save_high_volume(spark, sf_dir):
    root = staging(spark)
    sink.save_high_volume(risk.high_volume_accounts(_enriched(spark, sf_dir)), root)
    return spark.read.parquet(root)


@query
def save_edges(spark, sf_dir):
    root = staging(spark)
    sink.save_edges(_edges(spark, sf_dir), root, tasks=_tasks(spark))
    return _money(files.scan_edges(spark, root), "guarantee_amount_usd")


@query
def save_edges_again(spark, sf_dir):
    """All days are stored, then a second run without a date brings later days with other amounts: the others stay."""
    root = staging(spark)
    edges = _edges(spark, sf_dir)
    sink.save_edges(edges, root, tasks=_tasks(spark))
    amount = (F.col("guarantee_amount_usd") + 1).cast(schemas.MONEY)
    later = edges.filter(F.col("transaction_day") >= F.lit(AGAIN_FROM).cast("date"))
    sink.save_edges(later.withColumn("guarantee_amount_usd", amount), root, tasks=_tasks(spark))
    return _money(files.scan_edges(spark, root), "guarantee_amount_usd")


@query
def save_vendors(spark, sf_dir):
    root = staging(spark)
    sink.save_vendors(enriched_vendors(spark, sf_dir), root, RUN_DATE)
    return files.scan_enriched_vendors(spark, root, RUN_DATE).drop("processed_at")


@query
def save_vendors_json(spark, sf_dir):
    root = staging(spark)
    written = enriched_vendors_from_attempts(spark, sf_dir)
    sink.save_vendors_json(written, root, RUN_DATE)
    return spark.read.schema(written.schema).json(sink.run_folder(root, RUN_DATE))


# -- whole jobs ------------------------------------------------------------------------------------


def _outputs(spark, paths: jobs.Paths) -> DataFrame:
    """A row for each output of the transaction job: its rows and the sum of its amounts."""
    amounts = {
        "transactions": ("guarantee_amount_usd", files.scan_curated), "risk_metrics": ("total_guarantee_amount", files.scan_risk_metrics),
        "high_risk_accounts": ("total_amount", files.scan_high_volume), "graph_edges": ("guarantee_amount_usd", files.scan_edges),
        "rejected_lines": ("0", files.scan_rejected),
    }
    rows = [
        scan(spark, paths.out(name)).agg(
            F.lit(name).alias("output"), F.count("*").alias("n_rows"),
            F.coalesce(F.sum(F.expr(amount).cast("decimal(20,2)")).cast("double"), F.lit(0.0)).alias("amount"))
        for name, (amount, scan) in amounts.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def _run_transactions(spark, sf_dir, process_date) -> DataFrame:
    paths = jobs.Paths(_stage_transactions(spark, sf_dir), _stage_free_accounts(spark, sf_dir), "", staging(spark))
    jobs.run_transactions(spark, paths, process_date, tasks=_tasks(spark))
    return _outputs(spark, paths)


@query
def run_transactions(spark, sf_dir):
    """The transaction job for one process date, from monthly deliveries to its outputs."""
    return _run_transactions(spark, sf_dir, PROCESS_DATE)


@query
def run_transactions_all_days(spark, sf_dir):
    return _run_transactions(spark, sf_dir, None)


@query
def transaction_counters(spark, sf_dir):
    """What the transaction job counted while it wrote."""
    paths = jobs.Paths(_stage_transactions(spark, sf_dir), _stage_free_accounts(spark, sf_dir), "", staging(spark))
    return jobs.run_transactions(spark, paths, tasks=_tasks(spark)).drop("files_taken")


@query
def run_transactions_late(spark, sf_dir):
    """All days are done with half of the rows; a run for one date then does the days that the other half came for."""
    root, rows = staging(spark), tables.transactions(spark, sf_dir)
    paths = jobs.Paths(root, _stage_free_accounts(spark, sf_dir), "", staging(spark))
    _deliver(_half(rows, 0), root)
    jobs.run_transactions(spark, paths, tasks=_tasks(spark))
    _deliver(_half(rows, 1), root)
    jobs.run_transactions(spark, paths, PROCESS_DATE, late_days=True, tasks=_tasks(spark))
    return _amounts(files.scan_curated(spark, paths.out("transactions")).drop("processed_at"))


@query
def run_vendors(spark, sf_dir):
    paths = jobs.Paths("", "", _stage_vendors(spark, sf_dir), staging(spark))
    log = tables.attempt_log(spark, sf_dir)
    jobs.run_vendors(spark, paths, RUN_DATE, salt=SALT, attempts=log, multi_line=False)
    return files.scan_enriched_vendors(spark, paths.out("enriched_vendors"), RUN_DATE).drop("processed_at")


@query
def run_graph(spark, sf_dir):
    """A graph of all edges before a window, then the window's edges merged into it."""
    paths = jobs.Paths("", "", "", staging(spark))
    edges = _edges(spark, sf_dir)
    first, _ = quality.window_bounds(PROCESS_DATE)
    sink.save_edges(edges.filter(F.col("transaction_day") < F.lit(first)), paths.out("graph_edges"), tasks=_tasks(spark))
    jobs.run_graph(spark, paths, graph_path=paths.out("before"))
    sink.save_edges(edges, paths.out("graph_edges"), tasks=_tasks(spark))
    return _whole(jobs.run_graph(spark, paths, PROCESS_DATE, previous_graph=paths.out("before")), "value")


@query
def run_all(spark, sf_dir):
    """The three jobs for one date: the graph's counts and the counters of the lookups."""
    paths = jobs.Paths(
        _stage_transactions(spark, sf_dir), _stage_free_accounts(spark, sf_dir), _stage_vendors(spark, sf_dir), staging(spark))
    log = tables.attempt_log(spark, sf_dir)
    counts, counters = jobs.run_all(spark, paths, RUN_DATE, salt=SALT, attempts=log, multi_line=False)
    names = counters.columns
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("measure"), F.col(n).cast("long").alias("value")) for n in names])).alias("x")
    return _whole(counts, "value").unionByName(counters.select(pairs).select("x.*"))
