"""Row numbers, shards, splits and first occurrences, without a sort in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cadenza.storage import Scratch

#: Rows that one task may number.
TARGET = 1_000_000


def row_numbers(df: DataFrame, key: str, tie: list[str] | None = None, name: str = "rn", target: int = TARGET) -> DataFrame:
    """Numbers all rows from 1 in the order of ``key`` (then ``tie``); rows of null keys come first.

    Rows are dealt to ranges of about ``target`` and sorted there, which gives each its place within its range; they are
    written once, so the ranges stay. A range's first number is looked up by range: one row a range is all that is broadcast.
    """
    parts = max(1, -(-df.count() // target))
    order = [key, *(tie or [])]
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    stored = Scratch(df.sparkSession, "row-numbers").table(ranged, "ranges")
    sizes = stored.groupBy(F.shiftright("_id", 33).alias("_range")).agg(F.count(F.lit(1)).alias("_n"))
    firsts = sizes.select("_range", F.coalesce(F.sum("_n").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_first"))
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_first") + 1
    return stored.withColumn("_range", F.shiftright("_id", 33)).join(F.broadcast(firsts), "_range").withColumn(name, place).drop("_id", "_range", "_first")


def shards(df: DataFrame, key: str, size: int, **named) -> DataFrame:
    """Contiguous shards of ``size`` rows, from 0."""
    return row_numbers(df, key, **named).withColumn("shard", F.floor((F.col("rn") - 1) / size))


def balanced_ranks(df: DataFrame, key: str, ranks: int, **named) -> DataFrame:
    """Contiguous ranks (from 0) whose sizes differ by one at most, larger ones first."""
    n = df.count()
    per, extra = divmod(n, ranks)
    i = F.col("rn") - 1
    cut = extra * (per + 1)
    rank = F.when(i < cut, F.floor(i / (per + 1))).otherwise(extra + F.floor((i - cut) / max(per, 1)))
    return row_numbers(df, key, **named).withColumn("rank", rank.cast("long"))


def ranks_rest_last(df: DataFrame, key: str, ranks: int, **named) -> DataFrame:
    """Contiguous ranks of equal size, the last with the remainder."""
    per = max(1, df.count() // ranks)
    return row_numbers(df, key, **named).withColumn("rank", F.least(F.floor((F.col("rn") - 1) / per), F.lit(ranks - 1)).cast("long"))


def strided(df: DataFrame, key: str, ranks: int, **named) -> DataFrame:
    """Rank i takes every ``ranks``-th row."""
    return row_numbers(df, key, **named).withColumn("rank", F.pmod(F.col("rn") - 1, F.lit(ranks)))


def ordered_slice(df: DataFrame, key: str, offset: int, limit: int, tie: list[str] | None = None) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` by key: a top-k of the sum, so nothing is sorted whole."""
    return df.orderBy(key, *(tie or [])).limit(offset + limit).orderBy(key, *(tie or [])).offset(offset)


def first_occurrences(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row per key by a total order, as one partial aggregate."""
    rest = [c for c in df.columns if c not in key]
    kept = df.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return kept.select(*key, *[F.col("_row")[c].alias(c) for c in rest])


def shuffled(df: DataFrame, key: Column, seed: int) -> DataFrame:
    """A reproducible shuffle: ordered by a hash of seed and key."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string"))))


def shard_names(count: int = 256) -> Column:
    """array<string> of ``segment_00.lance`` and so on in two hex digits."""
    return F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: F.concat(F.lit("segment_"), F.lower(F.lpad(F.hex(i), 2, "0")), F.lit(".lance")))
