"""A membership bitmap of fixed size over 64-bit keys.

It is broadcast to map tasks as a filter in front of an exact join.  Its size
does not depend on the data (2 MB); with more keys it only lets more rows pass,
and the join behind it decides.  It never leaves out a key.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 24
SECOND = 8  # shift of the second probe
MASK = (1 << BITS) - 1


def build(keys: DataFrame, column: str) -> np.ndarray:
    """Words of the bitmap, two bits for each key; at most 2^18 rows reach the
    driver."""
    slots = [F.expr(f"shiftrightunsigned({column}, {64 - BITS}) & {MASK}"), F.expr(f"shiftrightunsigned({column}, {SECOND}) & {MASK}")]
    rows = (
        keys.where(F.col(column).isNotNull())
        .select(F.explode(F.array(*slots)).alias("slot"))
        .groupBy(F.shiftright("slot", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits"))
        .toPandas()
    )
    words = np.zeros(1 << (BITS - 6), np.uint64)
    words[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    return words


def probe(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    found = np.ones(len(keys), bool)
    for shift in (64 - BITS, SECOND):
        slot = (keys.view(np.uint64) >> np.uint64(shift)) & np.uint64(MASK)
        found &= (words[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) > 0
    return found
