"""Bitmaps of fixed size as filters before a shuffle: a false hit costs a shipped row, nothing else."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of one part: what `bitmap_construct_agg` makes.
_PART = 32768


def bitmap(values: DataFrame, column: str, bits: int) -> np.ndarray:
    """A bitmap of 2^bits bits, set at the low bits of the values. Each part of 4 KB is made by one reducer;
    the driver gets 2^bits bits, however many values there are."""
    low = F.col(column).bitwiseAND((1 << bits) - 1)
    rows = (
        values.select(F.shiftright(low, 15).alias("part"), low.bitwiseAND(_PART - 1).alias("bit"))
        .repartition("part")
        .groupBy("part")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
        .collect()
    )
    size = _PART // 8
    out = np.zeros(max((1 << bits) // 8, size), np.uint8)
    for row in rows:
        out[row["part"] * size : (row["part"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)
    return out


def held(bitmap: np.ndarray, values: np.ndarray, bits: int) -> np.ndarray:
    """Whether the bit of each value is set."""
    at = values.astype(np.uint64) & np.uint64((1 << bits) - 1)
    return (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
