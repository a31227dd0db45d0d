"""Ordered-sequence operators: numbering, change points, islands, peaks, folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def number_occurrences(df: DataFrame, group: list[str], label: str, order: list[str]) -> DataFrame:
    """Adds label_idx (from 1, per group and label, in order) and label_numbered. Number before filtering: gaps are meant."""
    w = W.partitionBy(*group, label).orderBy(*order)
    out = df.withColumn("label_idx", F.row_number().over(w).cast("long"))
    return out.withColumn("label_numbered", F.concat(F.col(label), F.col("label_idx").cast("string")))


def change_points(df: DataFrame, group: list[str], state: Column, order: list[str], initial: Column | None = None) -> DataFrame:
    """The rows whose state differs from the row before; the first row is compared with ``initial`` (null: it always counts)."""
    w = W.partitionBy(*group).orderBy(*order)
    before = F.lag("_state").over(w)
    first = F.row_number().over(w) == 1
    marked = df.withColumn("_state", state).withColumn("_before", before).withColumn("_first", first)
    start = F.lit(True) if initial is None else ~F.col("_state").eqNullSafe(initial)
    return marked.filter(F.when(F.col("_first"), start).otherwise(~F.col("_state").eqNullSafe(F.col("_before")))).drop("_state", "_before", "_first")


def islands(df: DataFrame, group: list[str], state: str, order: list[str], start: str, end: str) -> DataFrame:
    """Adjacent rows of equal state merged to one span: group, state, start of the first, end of the last, n rows."""
    w = W.partitionBy(*group).orderBy(*order)
    new = (~F.col(state).eqNullSafe(F.lag(state).over(w)) | (F.row_number().over(w) == 1)).cast("int")
    runs = df.withColumn("_new", new).withColumn("_run", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return runs.groupBy(*group, "_run", state).agg(F.min(start).alias(start), F.max(end).alias(end), F.count(F.lit(1)).alias("n")).drop("_run")


def fill_end(df: DataFrame, group: list[str], order: list[str], start: str, end: str) -> DataFrame:
    """A missing end becomes the next start."""
    return df.withColumn(end, F.coalesce(F.col(end), F.lead(start).over(W.partitionBy(*group).orderBy(*order))))


def spans_of_changes(df: DataFrame, group: list[str], time: str, order: list[str], last: Column) -> DataFrame:
    """Adds ``end``: the next change's time, or ``last``."""
    return df.withColumn("end", F.coalesce(F.lead(time).over(W.partitionBy(*group).orderBy(*order)), last))


def intervals_of_boundaries(df: DataFrame, group: list[str], time: str, order: list[str]) -> DataFrame:
    """Each boundary but the last with the next one as its ``end``."""
    return df.withColumn("end", F.lead(time).over(W.partitionBy(*group).orderBy(*order))).filter("end IS NOT NULL")


def differences(df: DataFrame, group: list[str], value: str, order: list[str]) -> DataFrame:
    return df.withColumn("difference", F.col(value) - F.lag(value).over(W.partitionBy(*group).orderBy(*order)))


def local_maxima(df: DataFrame, group: list[str], value: str, order: list[str], size: int = 3) -> DataFrame:
    """Adds ``peak``: the value where it is the largest of ``size`` (odd) around it, else 0; plateaus keep all."""
    w = W.partitionBy(*group).orderBy(*order).rowsBetween(-(size // 2), size // 2)
    return df.withColumn("peak", F.when(F.col(value) == F.max(value).over(w), F.col(value)).otherwise(F.lit(0.0)))


def pick_peaks(df: DataFrame, group: list[str], value: str, order: list[str], back: int, ahead: int) -> DataFrame:
    """Adds is_peak (positive, and the largest from ``back`` before to ``ahead`` after) and strength: the value above the mean of the two sides, missing frames counting as 0."""
    w = W.partitionBy(*group).orderBy(*order)
    past = F.coalesce(F.sum(value).over(w.rowsBetween(-back, -1)), F.lit(0.0)) / back
    future = F.coalesce(F.sum(value).over(w.rowsBetween(1, ahead)), F.lit(0.0)) / ahead
    top = F.max(value).over(w.rowsBetween(-back, ahead))
    return df.withColumn("is_peak", (F.col(value) == top) & (F.col(value) > 0)).withColumn("strength", F.col(value) - (past + future) / 2)


def strict_maxima(df: DataFrame, group: list[str], value: str, order: list[str], reach: int = 20) -> DataFrame:
    """Adds ``maximum``: the value where it is larger than all within ``reach`` on both sides, else 0; the first and the last frame are none."""
    w = W.partitionBy(*group).orderBy(*order)
    past, future = F.max(value).over(w.rowsBetween(-reach, -1)), F.max(value).over(w.rowsBetween(1, reach))
    return df.withColumn("maximum", F.when((F.col(value) > past) & (F.col(value) > future), F.col(value)).otherwise(F.lit(0.0)))


def boundary_times(peaks: DataFrame, group: list[str], frame: str, duration: DataFrame, rate: float) -> DataFrame:
    """Distinct boundary times per group: 0, each frame over the frame rate, and the duration (from a frame of group and duration)."""
    own = [F.col(g) for g in group]
    found = peaks.select(*own, (F.col(frame) / rate).alias("time"))
    ends = duration.select(*own, F.explode(F.array(F.lit(0.0), F.col("duration").cast("double"))).alias("time"))
    return found.unionByName(ends).distinct()


def _pair(t: Column, label: Column) -> Column:
    return F.struct(t.cast("double").alias("t"), label.alias("label"))


def rule_fold(v: Column) -> Column:
    """Boundaries array<struct<t, label>>, the last one the end mark, with short and repeated ends merged.

    In turn: a first part under one second takes the following label; a last part under one second goes; a
    second part of the first label that begins by 10 s joins it; a last part of the label before it that lasts up to 10 s joins it.
    Two entries always stay.
    """
    at = lambda a, i: F.element_at(a, i + 1)  # noqa: E731  from 0
    n = F.size(v)

    def head(a: Column, keep: Column, relabel: bool) -> Column:
        j = F.coalesce(F.try_element_at(F.filter(F.sequence(F.lit(1), F.size(a) - 1), keep), F.lit(1)), F.size(a) - 1)
        first = _pair(at(a, F.lit(0))["t"], at(a, j - 1)["label"] if relabel else at(a, F.lit(0))["label"])
        return F.concat(F.array(first), F.slice(a, j + 1, F.size(a) - j))

    def tail(a: Column, keep: Column) -> Column:
        k = F.coalesce(F.array_max(F.filter(F.sequence(F.lit(0), F.size(a) - 2), keep)), F.lit(0))
        return F.concat(F.slice(a, F.lit(1), k + 1), F.slice(a, F.size(a), F.lit(1)))

    def last(a: Column) -> Column:
        return at(a, F.size(a) - 1)["t"]

    def guarded(a: Column, out) -> Column:
        return F.when(F.size(a) > 2, out(a)).otherwise(a)

    # each fold sees its input as a lambda variable, so none of them is worked out twice
    def over(a: Column, out) -> Column:
        return F.element_at(F.transform(F.array(a), lambda x: guarded(x, out)), 1)

    v = F.transform(v, lambda x: _pair(x["t"], x["label"]))
    v = over(v, lambda a: head(a, lambda j: at(a, j)["t"] - at(a, F.lit(0))["t"] >= 1.0, True))
    v = over(v, lambda a: tail(a, lambda k: last(a) - at(a, k)["t"] >= 1.0))
    v = over(v, lambda a: head(a, lambda j: (at(a, j)["label"] != at(a, F.lit(0))["label"]) | (at(a, j)["t"] > 10.0), False))
    v = over(v, lambda a: tail(a, lambda k: (k == 0) | (at(a, k)["label"] != F.element_at(a, F.greatest(k, F.lit(1)))["label"]) | (last(a) - at(a, k)["t"] > 10.0)))
    return F.when(n.isNotNull(), v)


def windows_of(n: Column, outer: int, inner: int, least: int) -> Column:
    """array<struct<outer, start, size>>: nested windows over n samples; rests of ``least`` samples or fewer go."""
    outers = F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1, F.lit(outer).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    outers = F.filter(outers, lambda s: F.least(F.lit(outer), n - s) > least)
    inners = lambda s: F.transform(F.sequence(s, F.least(s + outer, n) - 1, F.lit(inner).cast("long")), lambda i: F.struct(s.alias("outer"), i.alias("start"), (F.least(i + inner, F.least(s + outer, n)) - i).alias("size")))
    return F.filter(F.flatten(F.transform(outers, inners)), lambda x: x["size"] > least)


def bucket_width(max_t: Column, least: float = 5.0, most: float = 30.0, buckets: float = 30.0) -> Column:
    return F.greatest(F.lit(least), F.least(F.lit(most), max_t / buckets))


def elementary_intervals(points: DataFrame, group: list[str], time: str) -> DataFrame:
    """The intervals between consecutive distinct times."""
    return intervals_of_boundaries(points.select(*group, time).distinct(), group, time, [time])
