"""Keyed, interval and as-of joins. Join sides are left to the optimizer, which broadcasts by measured size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def last_wins(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row per key by a total order, as one partial aggregate."""
    rest = [c for c in df.columns if c not in key]
    kept = df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return kept.select(*key, *[F.col("_row")[c].alias(c) for c in rest])


def attach_metadata(results: DataFrame, segments: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Key results with their segments' metadata (last wins); results without metadata go. The results drive: repeated ones stay repeated."""
    return results.join(last_wins(segments, [key], order).drop(*order), key, "inner")


def unmatched(results: DataFrame, segments: DataFrame, key: str) -> DataFrame:
    return results.join(segments.select(key), key, "left_anti")


def attach_default(df: DataFrame, side: DataFrame, key: str, column: str, default: Column) -> DataFrame:
    """``column`` of a side that is unique by key, with a default where there is none."""
    return df.join(side.select(key, column), key, "left").withColumn(column, F.coalesce(F.col(column), default))


def keyed_merge(sources: list[DataFrame], key: str, order: list[str]) -> DataFrame:
    """All sources merged to one row per key: each field's first value that isn't null, by ``order``; rows without key go.

    One shuffle with partial aggregation, whatever the number of sources.
    """
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources).filter(F.col(key).isNotNull())
    fields = [c for c in rows.columns if c not in (key, *order)]
    at = F.struct(*order)
    return rows.groupBy(key).agg(*[F.min_by(F.when(F.col(c).isNotNull(), F.struct(c)), F.when(F.col(c).isNotNull(), at))[c].alias(c) for c in fields])


def merge_conflicts(sources: list[DataFrame], key: str, order: list[str], top: int = 10, preview: int = 200) -> DataFrame:
    """(field, kept, n): how often a later value that isn't null differs from the kept one, by field and the kept value's beginning; the ``top`` most."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources).filter(F.col(key).isNotNull())
    fields = [c for c in rows.columns if c not in (key, *order)]
    long = rows.select(key, *order, F.explode(F.create_map(*[x for c in fields for x in (F.lit(c), F.col(c).cast("string"))])).alias("field", "value")).filter(F.col("value").isNotNull())
    kept = F.first("value").over(W.partitionBy(key, "field").orderBy(*order))
    return long.withColumn("kept", kept).filter("value <> kept").groupBy("field", F.substring("kept", 1, preview).alias("kept")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "field", "kept").limit(top)


def overlap_join(left: DataFrame, right: DataFrame, on: list[str], least: float, bucket: float, names: tuple[str, str, str, str] = ("start", "end", "start_r", "end_r")) -> DataFrame:
    """Pairs of intervals of equal ``on`` that overlap by at least ``least``.

    Each interval is listed under the buckets it touches, pairs meet by an equi-join on the bucket, and a pair counts in
    its first common bucket only; a long interval costs as many rows as buckets, so the bucket should be near the usual length.
    """
    s, e, s2, e2 = names
    spread = lambda df, a, b: df.withColumn("_first", F.floor(F.col(a) / bucket)).withColumn("_bucket", F.explode(F.sequence(F.col("_first"), F.greatest(F.floor(F.col(b) / bucket), F.col("_first")))))
    a = spread(left, s, e)
    b = spread(right, s2, e2).withColumnRenamed("_first", "_first_r")
    pairs = a.join(b, [*on, "_bucket"]).filter(F.col("_bucket") == F.greatest("_first", "_first_r"))
    return pairs.filter(F.least(e, e2) - F.greatest(s, s2) >= least).drop("_first", "_first_r", "_bucket")


def points_in_intervals(points: DataFrame, spans: DataFrame, on: list[str], time: str, start: str, end: str, bucket: float) -> DataFrame:
    """Points with the half-open spans [start, end) that hold them."""
    p = points.withColumn("_bucket", F.floor(F.col(time) / bucket))
    s = spans.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col(start) / bucket), F.greatest(F.floor(F.col(end) / bucket), F.floor(F.col(start) / bucket)))))
    return p.join(s, [*on, "_bucket"]).filter((F.col(time) >= F.col(start)) & (F.col(time) < F.col(end))).drop("_bucket")


def asof_join(left: DataFrame, right: DataFrame, on: list[str], time: str, value: str, tie: str) -> DataFrame:
    """``left`` with the ``value`` of the latest right row at or before its time (null if none): one sort of both sides, no join."""
    a = left.select(*left.columns, F.lit(None).cast(right.schema[value].dataType).alias("_value"), F.lit(1).alias("_side"))
    b = right.select(*on, time, tie, F.col(value).alias("_value"), F.lit(0).alias("_side"))
    w = W.partitionBy(*on).orderBy(time, "_side", tie).rowsBetween(W.unboundedPreceding, 0)
    seen = a.unionByName(b, allowMissingColumns=True).withColumn(f"{value}_asof", F.last(F.when(F.col("_side") == 0, F.col("_value")), ignorenulls=True).over(w))
    return seen.filter("_side = 1").drop("_value", "_side")


def remaining(df: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key isn't done."""
    return df.join(done.select(*key), key, "left_anti")


def finished(df: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    return df.join(done.select(*key), key, "left_semi")


def merge_back(df: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """Results by row id, null where there are none."""
    return df.join(results, key, "left")


def match_overlaps_in_row(spans: Column, blocks: Column, least: float = 0.02) -> Column:
    """For arrays in one row: each span with ``asr_text``, the texts of the blocks that overlap it by ``least``, in order, one per line."""
    def texts(s: Column) -> Column:
        near = F.filter(blocks, lambda b: b["end"].isNotNull() & (F.greatest(F.lit(0.0), F.least(s["end"], b["end"]) - F.greatest(s["start"], b["start"])) >= least) & (F.trim(F.coalesce(b["text"], F.lit(""))) != ""))
        return F.array_join(F.transform(near, lambda b: F.trim(b["text"])), "\n")

    return F.transform(spans, lambda s: s.withField("asr_text", texts(s)))
