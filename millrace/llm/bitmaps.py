"""Bitmaps over 64-bit hashes that stop keys nobody has before they are shuffled.

A bitmap has ``BITS_A_KEY`` slots for every key counted, up to 2**``MOST_LOG2`` slots (32 MB), and
every key sets two of them, so about one other key in seventy passes. Beyond the largest size more
keys pass for nothing; no result depends on it, since an exact join follows everywhere.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_A_KEY = 16
LEAST_LOG2, MOST_LOG2 = 16, 28
_CHUNK_LOG2 = 15


class Bitmap(NamedTuple):
    bits: np.ndarray
    log2: int

    def _set(self, slot: np.ndarray) -> np.ndarray:
        return (self.bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 > 0

    def marked(self, values: np.ndarray) -> np.ndarray:
        """Which values may be among the keys: all that are, and few others."""
        values, mask = values.view(np.uint64), np.uint64((1 << self.log2) - 1)
        out = self._set(values & mask)
        some = np.flatnonzero(out)
        out[some] = self._set((values[some] >> np.uint64(32)) & mask)
        return out


def _slots(key: Column, log2: int) -> Column:
    mask = F.lit((1 << log2) - 1).cast("long")
    return F.explode(F.array(key.bitwiseAND(mask), F.shiftrightunsigned(key, 32).bitwiseAND(mask)))


def bitmap(keys: DataFrame, column: str) -> Bitmap:
    """A bitmap of the values of a long column; the driver sees its bits, never the keys."""
    count = keys.count()
    log2 = min(MOST_LOG2, max(LEAST_LOG2, (BITS_A_KEY * count - 1).bit_length() if count else 0))
    slot = keys.select(_slots(F.col(column), log2).alias("slot"))
    chunk = F.shiftright("slot", _CHUNK_LOG2).cast("int")
    rows = slot.groupBy(chunk.alias("chunk")).agg(
        F.bitmap_construct_agg(F.col("slot").bitwiseAND(F.lit((1 << _CHUNK_LOG2) - 1))).alias("bits")
    ).collect()
    out = np.zeros((1 << (log2 - _CHUNK_LOG2), 1 << (_CHUNK_LOG2 - 3)), np.uint8)
    for row in rows:
        out[row.chunk] = np.frombuffer(row.bits, np.uint8)
    return Bitmap(out.ravel(), log2)
