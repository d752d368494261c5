"""Tables whose parts are written beside the old ones and then switched to.

A table is a folder with one folder for each run that wrote to it, ``run=<id>/<part>=<value>/…``, and small numbered files
``_snapshots/<n>.json`` that say which run's folder holds each part. Readers take the highest number and read just those
folders. A run writes its parts into a folder of its own, and only the snapshot written last makes them visible, all at
once: a run that dies before leaves the table as it was, and what it wrote is never read. So a table can be replaced, or merged
into, while it is read.

One run at a time may publish a table; a second one that publishes the same number is refused. The folders of the last two
snapshots stay, so a reader has until the run after the next one; older ones, and those of runs that died, go at the next
publishing. The snapshots themselves stay: the difference of two says which parts changed in between.

The driver holds the names of the parts (days, buckets, deliveries), never rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from suretygraph.storage import file_names, read_text, remove, shuffles_go, write_text

SNAPSHOTS = "_snapshots"

#: A part's values by column, as they are written in folder names.
Part = dict[str, str]


@dataclass(frozen=True)
class Snapshot:
    """``folders`` maps a part (``day=1/hour=2``) to the run that wrote it, ``sizes`` a run to the number of parts it wrote;
    ``info`` is what the writer noted."""

    number: int = 0
    folders: dict[str, str] = field(default_factory=dict)
    info: dict = field(default_factory=dict)
    sizes: dict[str, int] = field(default_factory=dict)

    def paths(self, keep: Callable[[Part], bool] | None = None) -> list[str]:
        """The folders of the parts to keep: a run's whole folder where all it wrote is kept."""
        by_run: dict[str, list[str]] = {}
        for part, run in sorted(self.folders.items()):
            if keep is None or keep(part_values(part)):
                by_run.setdefault(run, []).append(part)
        return [
            path for run, parts in by_run.items()
            for path in ([f"run={run}"] if len(parts) == self.sizes.get(run) else [f"run={run}/{part}" for part in parts])]


def part_values(part: str) -> Part:
    return dict(x.split("=", 1) for x in part.split("/")) if part else {}


def is_published(spark: SparkSession, path: str) -> bool:
    return bool(_numbers(spark, path))


def _numbers(spark: SparkSession, path: str) -> list[int]:
    names = file_names(spark, f"{path}/{SNAPSHOTS}")
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))


def placed(rows: DataFrame, parts: Sequence[str], tasks: int | None = None) -> DataFrame:
    """Rows brought together by part before they are written: rebalanced, so that a small part is one file and a large one is
    split over tasks. Adaptive execution sizes the tasks by bytes, so very many small parts may come to few of them; ``tasks``
    sets their number instead, for a first load of years of days."""
    return rows.hint("rebalance", *parts) if tasks is None else rows.repartition(tasks, *parts)


@dataclass(frozen=True)
class Published:
    """A table at ``path`` with these columns, of which ``parts`` are folders, outermost first."""

    path: str
    schema: T.StructType
    parts: tuple[str, ...] = ()

    def snapshot(self, spark: SparkSession, number: int | None = None) -> Snapshot:
        """The current one, or an earlier one by its number; an empty one if there is none."""
        numbers = _numbers(spark, self.path)
        if number is None:
            number = numbers[-1] if numbers else 0
        if number not in numbers:
            return Snapshot()
        stored = json.loads(read_text(spark, f"{self.path}/{SNAPSHOTS}/{number:08d}.json"))
        return Snapshot(number, stored["folders"], stored["info"], stored["sizes"])

    def scan(self, spark: SparkSession, keep: Callable[[Part], bool] | None = None, snapshot: Snapshot | None = None) -> DataFrame:
        """The rows of the current snapshot, or of the parts to keep: other folders aren't even listed."""
        wanted = [f"{self.path}/{folder}" for folder in (snapshot or self.snapshot(spark)).paths(keep)]
        if not wanted:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).option("basePath", self.path).parquet(*wanted).select(*self.schema.names)

    def publish(
        self, rows: DataFrame, replaced: Callable[[Part], bool] | bool = False, info: dict | None = None,
        max_records_per_file: int = 0,
    ) -> Snapshot:
        """Writes rows and switches to them. The parts they have replace earlier ones; so do those that ``replaced`` names
        (True: all), which go even without new rows. ``info`` is added to what earlier runs noted."""
        spark = rows.sparkSession
        before = self.snapshot(spark)
        run = uuid4().hex
        folder = f"{self.path}/run={run}"
        writer = rows.select(*self.schema.names).write.option("maxRecordsPerFile", max_records_per_file)
        with shuffles_go(spark):
            (writer.partitionBy(*self.parts) if self.parts else writer).parquet(folder)
        goes = replaced if callable(replaced) else lambda _: replaced
        folders = {part: r for part, r in before.folders.items() if not goes(part_values(part))}
        parts = self._written(spark, folder)
        folders.update(dict.fromkeys(parts, run))
        return self._switch(spark, before, folders, info, before.sizes | {run: len(parts)})

    def note(self, spark: SparkSession, info: dict) -> Snapshot:
        """A new snapshot of the same folders with more noted."""
        before = self.snapshot(spark)
        return self._switch(spark, before, before.folders, info, before.sizes)

    def _switch(self, spark: SparkSession, before: Snapshot, folders: dict[str, str], info: dict | None, sizes: dict[str, int]) -> Snapshot:
        used = set(folders.values())
        now = Snapshot(before.number + 1, folders, before.info | (info or {}), {run: n for run, n in sizes.items() if run in used})
        write_text(spark, f"{self.path}/{SNAPSHOTS}/{now.number:08d}.json", json.dumps(
            {"folders": now.folders, "info": now.info, "sizes": now.sizes}))
        self._clean(spark, now, before)
        return now

    def _written(self, spark: SparkSession, folder: str) -> list[str]:
        found = [""]
        for column in self.parts:
            found = [f"{part}/{name}".lstrip("/") for part in found for name in sorted(file_names(spark, f"{folder}/{part}".rstrip("/")))
                     if name.startswith(f"{column}=")]
        return found

    def _clean(self, spark: SparkSession, now: Snapshot, before: Snapshot) -> None:
        kept = now.folders.items() | before.folders.items()
        runs = {run for _, run in kept}
        for part, run in self.snapshot(spark, now.number - 2).folders.items() - kept:
            if run in runs:
                remove(spark, f"{self.path}/run={run}/{part}")
        for name in file_names(spark, self.path):
            if name.startswith("run=") and name.removeprefix("run=") not in runs:
                remove(spark, f"{self.path}/{name}")

    def changed(self, spark: SparkSession, since: int) -> list[Part]:
        """The parts that aren't as they were in an earlier snapshot: new, replaced or gone."""
        old, new = self.snapshot(spark, since).folders, self.snapshot(spark).folders
        return [part_values(p) for p in sorted(old.keys() | new.keys()) if old.get(p) != new.get(p)]
