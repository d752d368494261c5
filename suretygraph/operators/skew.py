"""Keeps joins with grouped tables splittable."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_key(column: str) -> Column:
    """A second grouping column that follows from the first, so it doesn't change the groups.

    A table grouped by a key is left partitioned by that key, and a join on it then reads the groups in
    place. Adaptive execution splits a hot key only in a join whose two sides are both shuffled for it.
    With this column among the grouping keys the join shuffles the groups again (one row each), and the
    other side's hot key can be split over many tasks.
    """
    return F.crc32(column).alias("_split")
