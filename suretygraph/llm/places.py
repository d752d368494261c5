"""A total order over range partitions: every row's place, and no task holds more than its range. Built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from suretygraph.llm.arrow import put, row_of
from suretygraph.llm.staging import stored

#: A partition's rows are counted in the lower bits of ``monotonically_increasing_id``.
ROW_BITS = 33


def numbered(df: DataFrame, order: list[Column], column: str) -> DataFrame:
    """Adds each row's place in the order, from 1, as ``column`` (replaced if there is one).

    Rows are sorted by range partitions, which are written; a partition's first place is the number of rows in those before
    it. That sum runs over one row for each partition. Rows that are equal in ``order`` share a partition, so the order should
    end with something that tells them apart.
    """
    spread = df.repartitionByRange(*order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()
    rows = stored(spread.select(row_of(df).alias("_own"), at.alias("_at")), "sorted")
    part = F.shiftright("_at", ROW_BITS)
    counts = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = rows.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    place = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1)) + 1
    return put(placed.select("_own", place.alias(column)), "_own", column)
