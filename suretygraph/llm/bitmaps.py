"""Approximate sets of 64-bit keys of a bounded size, built by an aggregate and broadcast to Python workers.

A key that was put in is always found. Others are found by accident, so users take a hit for "perhaps" and check
it exactly afterwards. The set never outgrows ``most_bits``; beyond that it says "perhaps" more often, which costs
later steps time, not rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from suretygraph.llm.tokens import U

BITS_PER_KEY = 16
MOST_BITS = 1 << 28


class Bitmap:
    def __init__(self, cells: np.ndarray):
        self.cells = cells

    def __contains__(self, key: int) -> bool:
        return bool(self.hits(np.array([key], U))[0])

    def hits(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.cells):
            return np.zeros(len(keys), bool)
        out = np.ones(len(keys), bool)
        for shift in (0, 32):
            slot = (keys >> U(shift)) & U(len(self.cells) * 64 - 1)
            out &= (self.cells[(slot >> U(6)).astype(np.int64)] >> (slot & U(63))) & U(1) == 1
        return out


def bitmap(keys: DataFrame, column: str, most_bits: int = MOST_BITS) -> Bitmap:
    """The set of a stored table's keys (long, well mixed). The driver receives at most most_bits / 64 cells."""
    n = keys.count()
    if n == 0:
        return Bitmap(np.zeros(0, U))
    bits = 1 << 12
    while bits < min(n * BITS_PER_KEY, most_bits):
        bits <<= 1
    mask = F.lit(bits - 1)
    key = F.col(column)
    slots = F.array(key.bitwiseAND(mask), F.shiftrightunsigned(key, 32).bitwiseAND(mask))
    cells = (
        keys.select(F.explode(slots).alias("slot"))
        .groupBy(F.shiftrightunsigned("slot", 6).alias("cell"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits"))
        .toArrow()
    )
    out = np.zeros(bits // 64, U)
    out[cells["cell"].to_numpy()] = cells["bits"].to_numpy().astype(np.int64).view(U)
    return Bitmap(out)

