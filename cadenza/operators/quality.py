"""Transcript quality: repeated chunks, hallucination reasons, and what becomes of a bad transcript."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType, StringType, StructField, StructType

from cadenza.functions.text import char_profile, has_long_run, max_char_ratio, py_strip, unique_char_ratio


def find_repeat(text: str, shortest: int = 2, longest: int = 200) -> tuple[str | None, int]:
    """The chunk of the smallest size that directly repeats anywhere, at its leftmost place, and how often it comes there.

    For a size, places equal to the one a size further on are marked; a run of marks as long as the size is a repeat.
    """
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    for size in range(shortest, min(longest, len(chars) // 2) + 1):
        same = np.concatenate([[False], chars[:-size] == chars[size:], [False]])
        turns = np.flatnonzero(same[1:] != same[:-1])
        starts, ends = turns[::2], turns[1::2]
        long = np.flatnonzero(ends - starts >= size)
        if len(long):
            a, run = int(starts[long[0]]), int(ends[long[0]] - starts[long[0]])
            return text[a : a + size], 1 + run // size
    return None, 0


@pandas_udf(StructType([StructField("chunk", StringType()), StructField("count", LongType())]))
def repeated_chunk(texts: pd.Series) -> pd.DataFrame:
    found = [(None, 0) if t is None else find_repeat(t) for t in texts]
    return pd.DataFrame(found, columns=["chunk", "count"])


@dataclass(frozen=True)
class Limits:
    """Thresholds; a text under ``never`` characters is never bad, and only hard runs count under ``least``."""

    never: int = 1000
    least: int = 200
    hard_run: int = 80
    speed: float = 12.0
    unique: float = 0.10
    max_char: float = 0.55
    repeats: int = 6


def reasons(text: Column, duration: Column, limits: Limits, repeat: Column | None = None) -> Column:
    """Why a transcript is bad, in order; empty for a good one. ``repeat`` is ``repeated_chunk`` of the stripped text, if that rule is wanted."""
    t = py_strip(F.coalesce(text, F.lit("")))
    profile = char_profile(text)
    size = profile["length"]
    rules = [
        F.when(size / F.greatest(duration, F.lit(1e-3)) > limits.speed, "speed"),
        F.when(unique_char_ratio(profile) < limits.unique, "low_unique"),
        F.when(max_char_ratio(profile) > limits.max_char, "max_char_ratio"),
    ]
    if repeat is not None:
        rules.append(F.when(repeat["chunk"].isNotNull() & (repeat["count"] >= limits.repeats), "repeated_chunk"))
    none = F.array().cast("array<string>")
    soft = F.when(size < limits.least, none).otherwise(F.array_compact(F.array(*rules)))
    return F.when((size == 0) | (size < limits.never), none).when(has_long_run(t, limits.hard_run), F.array(F.lit("hard_same_char_run"))).otherwise(soft)


def metrics(text: Column, duration: Column, limits: Limits) -> Column:
    """struct<len, cps, unique_ratio, max_char_ratio>; the last three only for texts of ``never`` characters or more."""
    profile = char_profile(text)
    size = profile["length"]
    long = (size >= limits.never) & (size > 0)
    speed = size / F.greatest(duration, F.lit(1e-3))
    return F.struct(F.when(size > 0, size).alias("len"), F.when(long, speed).alias("cps"), F.when(long, unique_char_ratio(profile)).alias("unique_ratio"), F.when(long, max_char_ratio(profile)).alias("max_char_ratio"))


def compressed(text: Column, repeat: Column, keep: int = 3) -> Column:
    """The chunk ``keep`` times if the (raw) text has it more often, else the text."""
    return F.when(repeat["chunk"].isNotNull() & (repeat["count"] > keep), F.repeat(repeat["chunk"], F.lit(keep))).otherwise(text)


def fixed(text: Column, why: Column, repeat: Column, keep: int = 3) -> Column:
    """A bad transcript compressed if a repeated chunk is among its reasons, else blank; a good one as it is."""
    return F.when(F.size(why) == 0, text).when(F.array_contains(why, "repeated_chunk"), compressed(text, repeat, keep)).otherwise(F.lit(""))
