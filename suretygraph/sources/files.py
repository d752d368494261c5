"""Scans of the stored files."""

from __future__ import annotations

import re
from collections.abc import Callable, Collection, Iterable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from suretygraph import schemas
from suretygraph.constants import WINDOW_DAYS
from suretygraph.operators.quality import incremental_window, transaction_day, window_bounds
from suretygraph.published import Part, Published, is_published, part_values, placed
from suretygraph.storage import file_names

CORRUPT_COLUMN = "_corrupt"
DELIVERY_FOLDER, DELIVERY = "day", "delivery"
DELIVERY_FOLDERS = f"{DELIVERY_FOLDER}=[0-9][0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9]"
_DELIVERY_NAME = re.compile(f"{DELIVERY_FOLDER}=[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}")
#: How a folder's name writes a null.
NULL_PART = "__HIVE_DEFAULT_PARTITION__"


def scan_transactions(
    spark: SparkSession, root: str, process_date=None, *, days: int = WINDOW_DAYS, keep_corrupt: bool = False
) -> DataFrame:
    """Daily transaction CSVs under ``root/day=YYYY-MM-DD/``, with ``transaction_day`` added.

    ``process_date`` keeps the ``days`` days ending there, by the event's own timestamp. All folders are read, as
    nothing is known of what they hold; a job that runs every day takes them in once (``take_in``) and reads the
    window from there.
    ``keep_corrupt`` adds ``_corrupt`` with the raw text of lines that do not fit the schema;
    either way the cells that can't be parsed are null and later fail validation. A file whose header has
    other columns, or another order, is refused.
    """
    dated = transaction_day(_delivered(spark, root, keep_corrupt).drop(DELIVERY_FOLDER))
    return dated if process_date is None else incremental_window(dated, process_date, days=days)


def _delivered(spark: SparkSession, root: str, keep_corrupt: bool, files: Iterable[str] | None = None) -> DataFrame:
    fields = list(schemas.TRANSACTIONS.fields)
    if keep_corrupt:
        fields.append(T.StructField(CORRUPT_COLUMN, T.StringType()))
    fields.append(T.StructField(DELIVERY_FOLDER, T.DateType()))
    return (
        spark.read.schema(T.StructType(fields))
        .option("header", True)
        .option("basePath", root)
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv([f"{root}/{DELIVERY_FOLDERS}"] if files is None else list(files))
    )


# -- intake: delivered files, each taken once as it is ----------------------------------------------


def intake_rows(store: str) -> Published:
    """Lines taken in, by delivery, the take that brought them, and the event's day."""
    return Published(f"{store}/rows", schemas.INTAKE, (DELIVERY, "take", "transaction_day"))


def intake_files(store: str) -> Published:
    """The manifest: the files taken, with length and time, by the delivery and take that brought them."""
    return Published(f"{store}/files", schemas.FILES_TAKEN, (DELIVERY, "take"))


def rejected(path: str) -> Published:
    """Lines that don't fit the schema, by delivery and take."""
    return Published(path, schemas.REJECTED_LINES, (DELIVERY, "take"))


def delivered_files(spark: SparkSession, root: str) -> DataFrame:
    """``file`` (below ``root``), ``length``, ``modified`` (milliseconds) and ``delivery`` of the files in delivery folders; their
    content isn't read. Folders with other names than ``day=YYYY-MM-DD`` are no deliveries."""
    if not any(_DELIVERY_NAME.fullmatch(name) for name in file_names(spark, root)):
        return spark.createDataFrame([], schemas.FILES_TAKEN).drop("take")
    listed = spark.read.format("binaryFile").load(f"{root}/{DELIVERY_FOLDERS}").select(
        F.regexp_extract("path", f"/({_DELIVERY_NAME.pattern}/.*)$", 1).alias("file"), "length",
        F.unix_millis("modificationTime").alias("modified"))
    day = F.try_to_date(F.substring("file", len(DELIVERY_FOLDER) + 2, 10), "yyyy-MM-dd")
    return listed.withColumn(DELIVERY, day).filter(F.col(DELIVERY).isNotNull())


@dataclass(frozen=True)
class Taken:
    """What an intake brought: deliveries with added files, deliveries taken anew, files and rows read, lines rejected."""

    grown: tuple[str, ...] = ()
    anew: tuple[str, ...] = ()
    files: int = 0
    lines: int = 0
    rejected: int = 0


def take_in(
    spark: SparkSession, root: str, store: str, again: Iterable[str] = (), rejected_path: str | None = None, tasks: int | None = None
) -> Taken:
    """Takes delivered CSV files into ``store``, each once: Parquet by delivery and by the event's day, whatever folder the
    event came in. Lines that don't fit the schema keep their text as ``_corrupt``, and go to ``rejected_path`` too.

    The files there are are joined with the manifest of those taken. Files it doesn't know are taken, and only they are read;
    a delivery with a file of another length or time than it knows, or with a new file where a known one is gone, is taken anew,
    from all the files it has now, and so are the deliveries that ``again`` names (YYYY-MM-DD). Files that are merely gone stay
    taken, as sources may be cleaned up. The rows are published before the manifest, so what a run that died has brought is taken again, in the place of its own rows.
    Names of files and folders come to the driver, no rows. ``tasks`` sets the number of writers.
    """
    again = set(again)
    rows, manifest = intake_rows(store), intake_files(store)
    known = manifest.scan(spark).select("file", F.col("length").alias("_length"), F.col("modified").alias("_modified"))
    same = (F.col("length") == F.col("_length")) & (F.col("modified") == F.col("_modified"))
    state = F.when(F.col(DELIVERY).cast("string").isin(list(again)), "anew").when(F.col("_length").isNull(), "added").when(~same, "anew")
    listed = delivered_files(spark, root).join(known, "file", "left").withColumn("state", state).select(
        "file", "length", "modified", F.col(DELIVERY).cast("string").alias(DELIVERY), "state")
    chosen = listed.filter(F.col("state").isNotNull()).collect()
    anew = {r[DELIVERY] for r in chosen if r["state"] == "anew"}
    added = sorted({r[DELIVERY] for r in chosen} - anew)
    if added:
        gone = manifest.scan(spark, lambda part: part[DELIVERY] in added).join(listed.select("file"), "file", "left_anti")
        anew |= {str(r[0]) for r in gone.select(DELIVERY).distinct().collect()}
    if anew:
        chosen = [r for r in chosen if r[DELIVERY] not in anew] + listed.filter(F.col(DELIVERY).isin(sorted(anew))).collect()
    # Rows that no manifest speaks of are those of a run that died before it wrote one.
    spoken_of = {(p[DELIVERY], p["take"]) for p in map(part_values, manifest.snapshot(spark).folders)}
    before = rows.snapshot(spark)
    lost = {(p[DELIVERY], p["take"]) for p in map(part_values, before.folders)} - spoken_of
    if not chosen and not lost:
        return Taken()

    def goes(part: Part) -> bool:
        return part[DELIVERY] in anew or (part[DELIVERY], part["take"]) in lost

    take = before.number + 1
    counts = Observation("intake")
    if chosen:
        read = transaction_day(_delivered(spark, root, True, [f"{root}/{r.file}" for r in chosen])).withColumnRenamed(DELIVERY_FOLDER, DELIVERY)
        read = read.withColumn("take", F.lit(take)).select(*schemas.INTAKE.names).observe(
            counts, F.count("*").alias("lines"), F.count_if(F.col(CORRUPT_COLUMN).isNotNull()).alias("rejected"))
        rows.publish(placed(read, [DELIVERY, "transaction_day"], tasks), goes)
    else:
        rows.publish(spark.createDataFrame([], schemas.INTAKE), goes)
    mine = rows.scan(spark, lambda part: int(part["take"]) == take)
    if rejected_path is not None:
        bad = mine.filter(F.col(CORRUPT_COLUMN).isNotNull()).select(F.col(CORRUPT_COLUMN).alias("line"), DELIVERY, "take")
        rejected(rejected_path).publish(bad, goes)
    taken = spark.createDataFrame(
        [(r.file, r.length, r.modified, date.fromisoformat(r[DELIVERY]), take) for r in chosen], schemas.FILES_TAKEN)
    manifest.publish(taken, goes)
    seen = counts.get if chosen else {}
    return Taken(tuple(sorted({r[DELIVERY] for r in chosen} - anew)), tuple(sorted(anew)), len(chosen), seen.get("lines", 0), seen.get("rejected", 0))


def days_changed(spark: SparkSession, store: str, since: int) -> set[str]:
    """The event days of parts of the intake that aren't as they were in an earlier snapshot of its rows (0: all days)."""
    return {p["transaction_day"] for p in intake_rows(store).changed(spark, since)} - {NULL_PART}


def window_days(process_date, days: int = WINDOW_DAYS) -> set[str]:
    first, _ = window_bounds(process_date, days)
    return {str(first + timedelta(n)) for n in range(days)}


def scan_taken_in(
    spark: SparkSession, store: str, process_date=None, *, days: int = WINDOW_DAYS, keep_corrupt: bool = False,
    wanted: Collection[str] | None = None,
) -> DataFrame:
    """Transactions taken in: all days, one window, or the days ``wanted`` (YYYY-MM-DD). Only these days' folders are read."""
    if wanted is None and process_date is not None:
        wanted = window_days(process_date, days)
    rows = intake_rows(store).scan(spark, None if wanted is None else lambda part: part["transaction_day"] in wanted)
    if wanted is not None:
        rows = rows.filter(F.col("transaction_day").isin([date.fromisoformat(d) for d in sorted(wanted)]))
    return rows.drop(DELIVERY, "take", *([] if keep_corrupt else [CORRUPT_COLUMN]))


def rejected_lines(spark: SparkSession, store: str) -> DataFrame:
    """Lines taken in that don't fit the schema, with their delivery."""
    rows = intake_rows(store).scan(spark)
    return rows.filter(F.col(CORRUPT_COLUMN).isNotNull()).select(DELIVERY, F.col(CORRUPT_COLUMN).alias("line"))


# -- stored tables ---------------------------------------------------------------------------------


def _by_day(spark: SparkSession, path: str, schema: T.StructType, keep: Callable[[str], bool] | None = None) -> DataFrame:
    """A table with days: the published parts if it is published, else its folders. ``keep`` says which days' parts to read."""
    if is_published(spark, path):
        part = None if keep is None else lambda p: "transaction_day" not in p or keep(p["transaction_day"])
        return Published(path, schema, ("transaction_day",)).scan(spark, part)
    return spark.read.schema(schema).parquet(path)


def scan_free_accounts(spark: SparkSession, path: str) -> DataFrame:
    """Promotional accounts from CSV, plain or gzip."""
    return spark.read.schema(schemas.FREE_ACCOUNTS).option("header", True).csv(path)


def scan_vendors(spark: SparkSession, path: str, *, multi_line: bool = True) -> DataFrame:
    """Vendor records from JSON: one array per file, or with ``multi_line=False`` one object a line.

    An array is parsed by one task per file, so large vendor sets belong in many files or in lines.
    """
    return spark.read.schema(schemas.VENDORS).option("multiLine", multi_line).json(path)


def scan_edges(spark: SparkSession, path: str, first_day=None, last_day=None) -> DataFrame:
    """Stored graph edges, all days or a range of days (pruned to their folders)."""
    first, last = (None if d is None else str(d)[:10] for d in (first_day, last_day))
    edges = _by_day(spark, path, schemas.GRAPH_EDGES, lambda day: (first is None or day >= first) and (last is None or day <= last))
    if first_day is not None:
        edges = edges.filter(F.col("transaction_day") >= F.lit(first_day).cast("date"))
    if last_day is not None:
        edges = edges.filter(F.col("transaction_day") <= F.lit(last_day).cast("date"))
    return edges


def scan_curated(
    spark: SparkSession, path: str, process_date=None, *, days: int = WINDOW_DAYS, wanted: Collection[str] | None = None
) -> DataFrame:
    """Stored curated transactions: all days, one window or the days ``wanted`` (pruned to their folders)."""
    if wanted is not None:
        return _by_day(spark, path, schemas.CURATED, lambda day: day in wanted).filter(
            F.col("transaction_day").isin([date.fromisoformat(d) for d in sorted(wanted)]))
    if process_date is None:
        return _by_day(spark, path, schemas.CURATED)
    window = window_days(process_date, days)
    return incremental_window(_by_day(spark, path, schemas.CURATED, lambda day: day in window), process_date, days=days)


def scan_risk_metrics(spark: SparkSession, path: str) -> DataFrame:
    return Published(path, schemas.RISK_METRICS).scan(spark)


def scan_high_volume(spark: SparkSession, path: str) -> DataFrame:
    return Published(path, schemas.HIGH_VOLUME_ACCOUNTS).scan(spark)


def scan_rejected(spark: SparkSession, path: str) -> DataFrame:
    return rejected(path).scan(spark).select(DELIVERY, "line")


def scan_enriched_vendors(spark: SparkSession, path: str, run_date: str | None = None) -> DataFrame:
    """Stored vendor records of one run date."""
    folder = f"{path}/day={run_date[:10] if run_date else 'unknown'}"
    return spark.read.schema(schemas.ENRICHED_VENDORS).parquet(folder)


def scan_outcomes(spark: SparkSession, path: str, run_date: str | None = None) -> DataFrame:
    """Stored lookup outcomes of one run date."""
    folder = f"{path}/day={run_date[:10] if run_date else 'unknown'}"
    return spark.read.schema(schemas.OUTCOMES).parquet(folder)
