"""Array and number expressions: probabilities, top-k, thresholds, time grids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sigmoid(c: Column) -> Column:
    return 1 / (1 + F.exp(-c))


def softmax(v: Column) -> Column:
    """Softmax of an array, shifted by its maximum; maximum and sum are bound as lambda variables, so each is worked out once."""
    with_most = F.array(F.struct(v.alias("v"), F.array_max(v).cast("double").alias("most")))
    shifted = F.transform(with_most, lambda s: F.transform(s["v"], lambda x: F.exp(x.cast("double") - s["most"])))
    with_sum = F.transform(shifted, lambda e: F.struct(e.alias("e"), F.aggregate(e, F.lit(0.0), lambda a, y: a + y).alias("sum")))
    return F.element_at(F.transform(with_sum, lambda s: F.transform(s["e"], lambda x: x / s["sum"])), 1)


def masked(v: Column, allowed: list[int]) -> Column:
    """An array with null in all places but the allowed ones (from 0)."""
    return F.transform(v, lambda x, i: F.when(i.isin(allowed), x))


def argmax(v: Column) -> Column:
    """The first place (from 0) of the largest value."""
    return (F.array_position(v, F.array_max(v)) - 1).cast("long")


def top_k(v: Column, k: int) -> Column:
    """The k largest as array<struct<at, value>>, larger first, earlier first among equals."""
    pairs = F.transform(v, lambda x, i: F.struct((-x).alias("down"), i.alias("at"), x.alias("value")))
    return F.transform(F.slice(F.array_sort(pairs), 1, k), lambda p: F.struct(p["at"].cast("long").alias("at"), p["value"].alias("value")))


def active_names(scores: Column, names: list[str], threshold: float) -> Column:
    """The names, sorted, whose score reaches the threshold."""
    listed = F.array(*[F.lit(n) for n in names])
    return F.array_sort(F.filter(F.zip_with(scores, listed, lambda s, n: F.when(s >= threshold, n)), lambda n: n.isNotNull()))


def frame_time(i: Column, duration: Column, n: Column) -> Column:
    return F.round(i * duration / n, 3)


def millis(t: Column) -> Column:
    """Whole milliseconds of rounded seconds; the product is truncated, as it is in floating point."""
    return (F.round(t, 3) * 1000).cast("long")


def normalize_names(v: Column) -> Column:
    """Stripped, not empty, distinct, sorted."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(v, lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != ""))))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def l2_normalize(v: Column) -> Column:
    norm = F.greatest(F.sqrt(dot(v, v)), F.lit(1e-12))
    return F.transform(v, lambda x: x.cast("double") / norm)


def nearest(v: Column, codebook: list[list[float]]) -> Column:
    """The place of the codebook vector nearest to the normalised ``v``; the first among equals."""
    return nearest_of(l2_normalize(v), codebook)


def nearest_of(v: Column, codebook: list[list[float]]) -> Column:
    """The place of the codebook vector nearest to ``v`` as it is; ``v`` and the distances are bound once."""
    book = F.array(*[F.array(*[F.lit(float(x)) for x in row]) for row in codebook])
    far = F.transform(F.array(v), lambda u: F.transform(book, lambda row: F.aggregate(F.zip_with(u, row, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)))
    return F.element_at(F.transform(far, lambda d: F.array_position(d, F.array_min(d)) - 1), 1).cast("long")


def compact_repeats(v: Column) -> Column:
    """Without the elements that equal the one before."""
    return F.filter(v, lambda x, i: (i == 0) | (x != F.element_at(v, F.when(i == 0, F.lit(1)).otherwise(i))))
