"""A bitmap of 64-bit keys, of a fixed size whatever their number.

It tells which keys of a text cannot be in a table, so that only the others go into the join with
it. The join stays exact: keys that share a bit only cost traffic.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits, as a power of two: 16 MB.
BITS = 27


@dataclass
class KeySet:
    """``words`` hold the bit of each key's lowest ``bits`` bits."""

    words: np.ndarray
    bits: int

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        """False for keys that were not put in."""
        low = keys & np.uint64((1 << self.bits) - 1)
        word = self.words[(low >> np.uint64(6)).astype(np.int64)]
        return word >> (low & np.uint64(63)) & np.uint64(1) > 0


def build(table: DataFrame, key: str, bits: int = BITS) -> KeySet:
    """The set of a bigint column: 2 ** (bits - 6) rows at most come to the driver."""
    low = F.col(key).bitwiseAND(F.lit((1 << bits) - 1))
    bit = F.expr(f"shiftleft(1L, cast({key} & 63 as int))")
    rows = (
        table.select(F.shiftright(low, 6).alias("at"), bit.alias("bit"))
        .groupBy("at")
        .agg(F.bit_or("bit").alias("word"))
        .toArrow()
    )
    words = np.zeros(1 << (bits - 6), dtype=np.int64)
    words[rows.column("at").to_numpy()] = rows.column("word").to_numpy()
    return KeySet(words.view(np.uint64), bits)
