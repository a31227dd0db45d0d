"""Aggregates over recordings, frames and fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cadenza.operators.sequences import bucket_width, differences, elementary_intervals, islands


def segments_per_song(df: DataFrame, song: str, start: str, order: list[str], fields: list[str], name: str = "song_structure_info") -> DataFrame:
    """One array of segments per song, by start, ties by ``order``."""
    item = F.struct(F.col(start).alias("_start"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.struct(*fields).alias("row"))
    return df.groupBy(song).agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["row"]).alias(name))


def status_counts(df: DataFrame, status: str, domain: list[str]) -> DataFrame:
    """Rows per status over a fixed domain, 0 where there are none; a single pass over the rows."""
    counts = df.agg(*[F.count_if(F.col(status) == s).alias(s) for s in domain])
    return counts.select(F.explode(F.create_map(*[x for s in domain for x in (F.lit(s), F.col(s))])).alias(status, "n"))


def tempo(df: DataFrame, group: list[str], time: str, order: list[str], low: float = 0.1, high: float = 3.0) -> DataFrame:
    """bpm per group: 60 over the mean of the beat intervals strictly between the bounds; null without any."""
    gaps = differences(df, group, time, order)
    good = (F.col("difference") > low) & (F.col("difference") < high)
    return gaps.groupBy(*group).agg((60.0 / F.avg(F.when(good, F.col("difference")))).alias("bpm"), F.count_if(good).alias("n_intervals"))


def voiced_summary(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """Mean, exact median and count of the positive values; 0 where there are none."""
    v = F.when(F.col(value) > 0, F.col(value))
    return df.groupBy(*group).agg(F.coalesce(F.avg(v), F.lit(0.0)).alias("mean"), F.coalesce(F.median(v), F.lit(0.0)).alias("median"), F.count(v).alias("n_voiced"))


def mean_vectors(df: DataFrame, group: list[str], vector: str) -> DataFrame:
    """Per group and place (from 0) the mean of the vectors' values."""
    return df.select(*group, F.posexplode(vector).alias("at", "x")).groupBy(*group, "at").agg(F.avg(F.col("x").cast("double")).alias("mean"))


def argmax_of_means(df: DataFrame, group: list[str], vector: str) -> DataFrame:
    """Per group the place with the largest mean, the first among equals."""
    return mean_vectors(df, group, vector).groupBy(*group).agg(F.max_by("at", F.struct("mean", -F.col("at"))).cast("long").alias("best"), F.max("mean").alias("mean"))


def labelled_parts(a: DataFrame, b: DataFrame, group: list[str], time: str, label: str) -> DataFrame:
    """(group, time, end, la, lb): the common time of two label tracks, cut at all boundaries, with the label in force on either.

    A track is boundaries with the label that begins there, the last one the end.
    """
    own = [F.col(g) for g in group]
    span = lambda t, n: t.groupBy(*own).agg(F.min(time).alias(f"lo_{n}"), F.max(time).alias(f"hi_{n}"))
    limits = span(a, "a").join(span(b, "b"), group).select(*own, F.greatest("lo_a", "lo_b").alias("lo"), F.least("hi_a", "hi_b").alias("hi")).filter("lo < hi")
    points = a.select(*own, time).unionByName(b.select(*own, time)).join(limits, group).filter(F.col(time).between(F.col("lo"), F.col("hi"))).select(*own, time)
    points = points.unionByName(limits.select(*own, F.explode(F.array("lo", "hi")).alias(time)))
    parts = elementary_intervals(points, group, time).withColumn("_probe", F.lit(1))
    rows = parts.unionByName(a.select(*own, time, F.col(label).alias("label_a")), allowMissingColumns=True).unionByName(b.select(*own, time, F.col(label).alias("label_b")), allowMissingColumns=True)
    w = W.partitionBy(*group).orderBy(time, F.coalesce("_probe", F.lit(0))).rowsBetween(W.unboundedPreceding, 0)
    named = rows.select(*own, time, "end", "_probe", F.last("label_a", ignorenulls=True).over(w).alias("la"), F.last("label_b", ignorenulls=True).over(w).alias("lb"))
    return named.filter("_probe = 1").drop("_probe")


def agreement(a: DataFrame, b: DataFrame, group: list[str], time: str, label: str) -> DataFrame:
    """Share of the common time in which two label tracks agree."""
    length = F.col("end") - F.col(time)
    return labelled_parts(a, b, group, time, label).groupBy(*group).agg((F.sum(F.when(F.col("la") == F.col("lb"), length).otherwise(0)) / F.sum(length)).alias("agreement"))


def structure_scores(truth: DataFrame, found: DataFrame, group: list[str], time: str, label: str, frame: float = 0.1) -> DataFrame:
    """Pairwise precision, recall and F, and the normalised conditional entropies (over- and under-segmentation, and their F), of two label tracks.

    Both are read at every ``frame`` seconds of their common time. All that the scores need is how many frames have each pair of
    labels, so frames aren't listed: an interval holds as many as there are multiples of ``frame`` in it.
    """
    own = [F.col(g) for g in group]
    n = F.ceil(F.col("end") / frame) - F.ceil(F.col(time) / frame)
    cells = labelled_parts(truth, found, group, time, label).groupBy(*own, "la", "lb").agg(F.sum(n).cast("double").alias("n")).filter("n > 0")
    rows, columns = W.partitionBy(*own, "la"), W.partitionBy(*own, "lb")
    cells = cells.withColumns({"of_a": F.sum("n").over(rows), "of_b": F.sum("n").over(columns), "all": F.sum("n").over(W.partitionBy(*own))})
    first = lambda w: F.row_number().over(w.orderBy("la", "lb")) == 1
    cells = cells.withColumns({"head_a": first(rows), "head_b": first(columns)})
    pairs = lambda c: c * (c - 1) / 2
    sums = cells.groupBy(*own).agg(
        F.sum(pairs(F.col("n"))).alias("both"), F.sum(F.when(F.col("head_a"), pairs(F.col("of_a")))).alias("in_a"), F.sum(F.when(F.col("head_b"), pairs(F.col("of_b")))).alias("in_b"),
        F.sum(-F.col("n") / F.col("all") * F.log2(F.col("n") / F.col("of_b"))).alias("a_given_b"), F.sum(-F.col("n") / F.col("all") * F.log2(F.col("n") / F.col("of_a"))).alias("b_given_a"),
        F.log2(F.count_if("head_a")).alias("z_a"), F.log2(F.count_if("head_b")).alias("z_b"),
    )
    f = lambda p, r: F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0)
    ratio = lambda x, y: F.when(F.col(y) > 0, F.col(x) / F.col(y)).otherwise(0.0)
    score = lambda x, z: F.when(F.col(z) > 0, 1 - F.col(x) / F.col(z)).otherwise(0.0)
    named = sums.select(*own, ratio("both", "in_b").alias("pw_precision"), ratio("both", "in_a").alias("pw_recall"), score("b_given_a", "z_b").alias("s_over"), score("a_given_b", "z_a").alias("s_under"))
    return named.withColumns({"pw_f": f(F.col("pw_precision"), F.col("pw_recall")), "s_f": f(F.col("s_over"), F.col("s_under"))})


def line_counts(df: DataFrame, text: str) -> DataFrame:
    """(lines, filled): all lines of all texts, and those that aren't blank."""
    return df.select(F.explode(F.split(text, "\n")).alias("line")).agg(F.count(F.lit(1)).alias("lines"), F.count_if(F.trim("line") != "").alias("filled"))


def bucket_union(df: DataFrame, group: list[str], time: str, end: str, name: str, max_t: Column, width: Column | None = None) -> DataFrame:
    """Spans of equal name sets: the names active per bucket of adaptive width (a bucket on the end boundary included), equal neighbours merged.

    Returns group, names (sorted, joined by ", "), start, end.
    """
    own = [F.col(g) for g in group]
    d = df.withColumn("_max", max_t.cast("double"))
    d = d.withColumn("_w", bucket_width(F.col("_max")) if width is None else width).withColumn("_n", F.greatest(F.lit(1), F.floor(F.col("_max") / F.col("_w")) + 1))
    d = d.filter(F.col(time) >= 0).withColumn("_b", F.explode(F.sequence(F.floor(F.col(time) / F.col("_w")), F.greatest(F.floor(F.col(time) / F.col("_w")), F.least(F.floor(F.col(end) / F.col("_w")), F.col("_n") - 1))))).filter("_b < _n")
    sets = d.groupBy(*own, "_b", "_w", "_max").agg(F.array_join(F.array_sort(F.collect_set(name)), ", ").alias("names"))
    spans = sets.select(*own, "_b", "names", (F.col("_b") * F.col("_w")).alias("start"), F.least((F.col("_b") + 1) * F.col("_w"), F.col("_max")).alias("end"))
    return islands(spans, group, "names", ["_b"], "start", "end")


def overlap_add(df: DataFrame, group: list[str], frame: str, value: str) -> DataFrame:
    """Sum over count per frame, 0 where a frame has no window."""
    return df.groupBy(*group, frame).agg((F.sum(value) / F.greatest(F.count(value), F.lit(1))).alias("value"))


def masked_mean(df: DataFrame, group: list[str], value: str, mask: str) -> DataFrame:
    return df.groupBy(*group).agg(F.avg(F.when(F.col(mask), F.col(value))).alias("mean"))


def run_counters(df: DataFrame, ok: Column, duration: str) -> DataFrame:
    return df.agg(F.count_if(ok).alias("ok"), F.count_if(~ok).alias("failed"), F.sum(F.when(ok, F.col(duration))).alias("total_duration"), F.count(F.lit(1)).alias("rows"))


def boundary_hit_rate(truth: DataFrame, found: DataFrame, group: list[str], time: str, window: float) -> DataFrame:
    """Precision, recall and F of boundaries that can be paired within ``window`` seconds, each with one at most.

    On a line the pairing that takes the earliest free partner in order is a largest one; it is folded per group over the merged, sorted times.
    """
    own = [F.col(g) for g in group]
    lists = lambda df, n: df.groupBy(*own).agg(F.array_sort(F.collect_set(time)).alias(n))
    both = lists(truth, "t").join(lists(found, "f"), group, "full").select(*own, *[F.coalesce(c, F.array().cast("array<double>")).alias(c) for c in ("t", "f")])
    start = F.struct(F.lit(0).alias("i"), F.lit(0).alias("hits"))

    def step(acc: Column, x: Column) -> Column:
        free = F.filter(F.sequence(F.lit(0), F.size("f")), lambda j: (j >= acc["i"]) & (j < F.size("f")) & (F.get("f", j) >= x - window))
        j = F.get(free, F.lit(0))
        hit = F.coalesce(F.get("f", j) <= x + window, F.lit(False))
        return F.struct(F.when(hit, j + 1).otherwise(F.coalesce(j, F.size("f"))).alias("i"), (acc["hits"] + hit.cast("int")).alias("hits"))

    hits = both.withColumn("hits", F.aggregate("t", start, step)["hits"])
    p, r = F.col("hits") / F.greatest(F.size("f"), F.lit(1)), F.col("hits") / F.greatest(F.size("t"), F.lit(1))
    return hits.select(*own, p.alias("precision"), r.alias("recall"), F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0).alias("f_measure"))


def conflict_free_first(df: DataFrame, key: list[str], value: str, order: list[str]) -> DataFrame:
    """The first value per key that isn't null."""
    has = F.col(value).isNotNull()
    return df.groupBy(*key).agg(F.min_by(F.when(has, F.col(value)), F.when(has, F.struct(*order))).alias(value))
