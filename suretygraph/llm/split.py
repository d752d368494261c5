"""The fixed division of rows into those to learn from and those held out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def held_out(id_col: str) -> Column:
    """Every third id by its CRC-32; a row without an id is never learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(True))


def draw(id_col: str, seed: str) -> Column:
    """A fixed order of ids that looks random, for bounded samples."""
    return F.xxhash64(F.lit(seed), F.col(id_col))
