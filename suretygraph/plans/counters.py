"""Counts of what the steps of a job let through, taken while its rows are written: no second pass.

They are Spark observations. A stage that runs again after an executor was lost may count its rows again, so the counts can be
too high then; the rows written are right whatever happens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from suretygraph.operators.quality import failures
from suretygraph.schemas import TRANSACTION_COUNTERS


def observed(observation: Observation) -> dict[str, int]:
    """What was counted; nothing where Spark found that a step has no rows and left it out."""
    # ``get`` fails on the empty row that stands for this.
    return observation.get if observation._jo.getRow().size() else {}


class TransactionCounters:
    """Watches the steps of one transaction run. ``row`` may be asked for once its rows are written."""

    def __init__(self, files: int = 0, lines: int = 0, rejected: int = 0):
        self._known = {"files_taken": files, "lines_taken": lines, "lines_rejected": rejected}
        self._observed: list[Observation] = []

    def _watch(self, rows: DataFrame, *counts: Column) -> DataFrame:
        observation = Observation()
        self._observed.append(observation)
        return rows.observe(observation, *counts)

    def read(self, rows: DataFrame) -> DataFrame:
        return self._watch(rows, F.count("*").alias("rows_read"), F.count_if(F.col("transaction_id").isNull()).alias("without_id"))

    def unique(self, rows: DataFrame) -> DataFrame:
        """After the deduplication; a row may fail several rules."""
        return self._watch(rows, F.count("*").alias("ids"), *[F.count_if(bad).alias(name) for name, bad in failures().items()])

    def valid(self, rows: DataFrame) -> DataFrame:
        return self._watch(rows, F.count("*").alias("valid"))

    def approved(self, rows: DataFrame) -> DataFrame:
        return self._watch(rows, F.count("*").alias("approved"))

    def written(self, rows: DataFrame) -> DataFrame:
        return self._watch(rows, F.count("*").alias("written"))

    def row(self, spark: SparkSession) -> DataFrame:
        counts = dict.fromkeys(TRANSACTION_COUNTERS.names, 0) | self._known
        for observation in self._observed:
            counts.update(observed(observation))
        counts["duplicates"] = counts["rows_read"] - counts["without_id"] - counts["ids"]
        counts["not_approved"] = counts["valid"] - counts["approved"]
        counts["promotional"] = counts["approved"] - counts["written"]
        return spark.createDataFrame([tuple(counts[name] for name in TRANSACTION_COUNTERS.names)], TRANSACTION_COUNTERS)
