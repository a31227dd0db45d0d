"""Bitmaps of fixed size over 64-bit keys: what isn't in one can be left out before anything is shuffled."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.words import U64

BITS = 26


def bitmap(keys: DataFrame) -> np.ndarray:
    """2**BITS bits with two of each of the column ``key`` set, as 64-bit words; they are put together by word, so their number bounds what is gathered."""
    place = F.explode(F.array(F.shiftrightunsigned("key", 64 - BITS), F.col("key").bitwiseAND(F.lit((1 << BITS) - 1))))
    words = keys.select(place.alias("place")).select(F.shiftright("place", 6).cast("int").alias("word"), F.expr("shiftleft(1L, cast(place % 64 as int))").alias("bits")).groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (BITS - 6), dtype=U64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().view(U64)
    return out


def contains(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys may be in the bitmap; a key of its own always is."""
    def is_set(place: np.ndarray) -> np.ndarray:
        return (bits[(place >> U64(6)).astype(np.int64)] >> (place & U64(63))) & U64(1) != 0

    out = is_set(keys >> U64(64 - BITS))
    some = np.flatnonzero(out)
    out[some] = is_set(keys[some] & U64((1 << BITS) - 1))
    return out
