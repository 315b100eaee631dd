"""A Bloom filter of fixed size over hashes, to thin out rows before a join.

It takes 8 MB however many hashes it holds, so it may be sent to every task.
When it fills up it lets more rows pass; the join behind it stays exact.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BITS = 26
_MASK = (1 << _BITS) - 1


def build(df: DataFrame, hashed: Column) -> np.ndarray:
    """The filter over a column of 64-bit hashes: 2**20 words of 64 bits."""
    places = F.array(hashed.bitwiseAND(_MASK), F.shiftrightunsigned(hashed, _BITS).bitwiseAND(_MASK))
    words = (
        df.select(F.explode(places).alias("place"))
        .groupBy(F.shiftright("place", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits"))
        .toArrow()
    )
    table = np.zeros(1 << (_BITS - 6), dtype=np.uint64)
    table[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return table


def might_hold(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes may be in the filter; never false for one that is."""
    held = np.ones(len(hashes), dtype=bool)
    for shift in (0, _BITS):
        place = (hashes >> np.uint64(shift)) & np.uint64(_MASK)
        word = table[(place >> np.uint64(6)).astype(np.int64)]
        held &= (word >> (place & np.uint64(63))) & np.uint64(1) == 1
    return held
