"""Queries of the ordered-sequence and aggregate operators."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cadenza.functions import arrays as A
from cadenza.operators import aggregates as G
from cadenza.operators import reshape as R
from cadenza.operators import sequences as S
from cadenza.plans.registry import events, query, table

ORDER = ["us", "event_id"]


@query("wn01_numbered_segments", """
SELECT event_id, song, label, row_number() OVER w AS label_idx, label || (row_number() OVER w)::VARCHAR AS label_numbered
FROM {events} WINDOW w AS (PARTITION BY song, label ORDER BY us, event_id)""")
def wn01(spark, sf):
    return S.number_occurrences(events(spark, sf), ["song"], "label", ORDER).select("event_id", "song", "label", "label_idx", "label_numbered")


@query("wn02_change_points", """
SELECT event_id, song, label FROM (SELECT *, lag(label) OVER (PARTITION BY song ORDER BY us, event_id) AS b FROM {events}) WHERE label IS DISTINCT FROM b""")
def wn02(spark, sf):
    return S.change_points(events(spark, sf), ["song"], F.col("label"), ORDER).select("event_id", "song", "label")


@query("wn03_compaction", """
SELECT song, string_agg(label, ' ' ORDER BY us, event_id) AS labels FROM (
  SELECT *, lag(label) OVER (PARTITION BY song ORDER BY us, event_id) AS b FROM {events}) WHERE label IS DISTINCT FROM b GROUP BY song""")
def wn03(spark, sf):
    listed = events(spark, sf).groupBy("song").agg(F.transform(F.array_sort(F.collect_list(F.struct("us", "event_id", "label"))), lambda x: x["label"]).alias("v"))
    return listed.select("song", F.array_join(A.compact_repeats(F.col("v")), " ").alias("labels"))


@query("wn04_islands", """
SELECT song, label, min(us) AS first_us, max(us) AS last_us, count(*) AS n FROM (
  SELECT *, sum(new) OVER (PARTITION BY song ORDER BY us, event_id) AS run FROM (
    SELECT *, CASE WHEN label = lag(label) OVER (PARTITION BY song ORDER BY us, event_id) THEN 0 ELSE 1 END AS new FROM {events})) GROUP BY song, run, label""")
def wn04(spark, sf):
    rows = events(spark, sf).withColumns({"first_us": F.col("us"), "last_us": F.col("us")})
    return S.islands(rows, ["song"], "label", ORDER, "first_us", "last_us").select("song", "label", "first_us", "last_us", "n")


@query("wn05_fill_end", """
SELECT event_id, song, us, CASE WHEN event_id % 3 = 0 THEN us + 1000000 ELSE lead(us) OVER (PARTITION BY song ORDER BY us, event_id) END AS end_us FROM {events}""")
def wn05(spark, sf):
    rows = events(spark, sf).withColumn("end_us", F.when(F.col("event_id") % 3 == 0, F.col("us") + 1000000))
    return S.fill_end(rows, ["song"], ORDER, "us", "end_us").select("event_id", "song", "us", "end_us")


@query("wn06_change_spans", """
SELECT event_id, song, us, coalesce(lead(us) OVER (PARTITION BY song ORDER BY us, event_id), us + 5000000) AS "end" FROM {events}""")
def wn06(spark, sf):
    return S.spans_of_changes(events(spark, sf), ["song"], "us", ORDER, F.col("us") + 5000000).select("event_id", "song", "us", "end")


@query("wn07_differences", "SELECT event_id, us - lag(us) OVER (PARTITION BY song ORDER BY us, event_id) AS difference FROM {events}")
def wn07(spark, sf):
    return S.differences(events(spark, sf), ["song"], "us", ORDER).select("event_id", "difference")


@query("wn08_local_maxima", """
SELECT event_id, CASE WHEN value = max(value) OVER (PARTITION BY song ORDER BY us, event_id ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) THEN value ELSE 0.0 END AS peak FROM {events}""")
def wn08(spark, sf):
    return S.local_maxima(events(spark, sf), ["song"], "value", ORDER).select("event_id", "peak")


@query("wn09_peaks", """
SELECT event_id, value = max(value) OVER (PARTITION BY song ORDER BY us, event_id ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AND value > 0 AS is_peak,
  round(value - (coalesce(sum(value) OVER (PARTITION BY song ORDER BY us, event_id ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 0) / 3
    + coalesce(sum(value) OVER (PARTITION BY song ORDER BY us, event_id ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING), 0) / 3) / 2, 4) AS strength FROM {events}""")
def wn09(spark, sf):
    return S.pick_peaks(events(spark, sf), ["song"], "value", ORDER, 3, 3).select("event_id", "is_peak", F.round("strength", 4).alias("strength"))


@query("wn10_boundary_times", """
WITH f AS (SELECT song, row_number() OVER (PARTITION BY song ORDER BY us, event_id) AS frame, value FROM {events}),
d AS (SELECT song, count(*)::DOUBLE AS duration FROM f GROUP BY song)
SELECT DISTINCT song, round(time, 6) AS time FROM (SELECT song, frame / 8.0 AS time FROM f WHERE value > 100 UNION ALL SELECT song, 0.0 FROM d UNION ALL SELECT song, duration FROM d)""")
def wn10(spark, sf):
    frames = events(spark, sf).withColumn("frame", F.row_number().over(W.partitionBy("song").orderBy(*ORDER)))
    return S.boundary_times(frames.filter("value > 100"), ["song"], "frame", frames.groupBy("song").agg(F.count(F.lit(1)).alias("duration")), 8.0).select("song", F.round("time", 6).alias("time"))


@query("wn11_rule_fold")
def wn11(spark, sf):
    v = F.array_sort(F.collect_list(F.struct((F.col("us") - F.col("first")).cast("double").alias("t"), "event_id", "label")))
    rows = events(spark, sf).withColumn("first", F.min("us").over(W.partitionBy("song"))).groupBy("song").agg(F.transform(v, lambda x: F.struct((x["t"] / 3.6e9).alias("t"), x["label"].alias("label"))).alias("v"))
    return rows.select("song", F.posexplode(S.rule_fold(F.col("v"))).alias("pos", "x")).select("song", "pos", "x.*")


@query("wn13_tumbling", """
WITH n AS (SELECT doc_id, n_chars AS n FROM documents), o AS (SELECT doc_id, n, unnest(range(0, n, 420)) AS o FROM n),
i AS (SELECT doc_id, o, least(o + 420, n) AS e, unnest(range(o, least(o + 420, n), 30)) AS start FROM o WHERE least(420, n - o) > 10)
SELECT doc_id, o AS "outer", start, least(start + 30, e) - start AS size FROM i WHERE least(start + 30, e) - start > 10""")
def wn13(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.explode(S.windows_of(F.col("n_chars").cast("long"), 420, 30, 10)).alias("x")).select("doc_id", "x.*")


@query("wn14_bucket_width", "SELECT doc_id, greatest(5.0::DOUBLE, least(30.0::DOUBLE, n_chars / 30.0::DOUBLE)) AS width FROM documents")
def wn14(spark, sf):
    return table(spark, sf, "documents").select("doc_id", S.bucket_width(F.col("n_chars")).alias("width"))


@query("wn15_elementary", """
SELECT song, us, "end" FROM (SELECT song, us, lead(us) OVER (PARTITION BY song ORDER BY us) AS "end" FROM (SELECT DISTINCT song, us FROM {events} WHERE label IN ('view', 'click'))) WHERE "end" IS NOT NULL""")
def wn15(spark, sf):
    return S.elementary_intervals(events(spark, sf).filter(F.col("label").isin("view", "click")), ["song"], "us")


@query("prj08_clamp_pad", """
SELECT event_id, round(cs, 6) AS clip_start, round(ce, 6) AS clip_end FROM (SELECT event_id, greatest(0, least(total, s - 0.5)) AS cs, greatest(0, least(total, e + 0.5)) AS ce FROM (
  SELECT event_id, label, (us - f) / 1e6 AS s, (n - f) / 1e6 AS e, (l - f) / 1e6 - 1 AS total FROM (SELECT *, lead(us) OVER (PARTITION BY song ORDER BY us, event_id) AS n, min(us) OVER (PARTITION BY song) AS f, max(us) OVER (PARTITION BY song) AS l FROM {events}) WHERE n IS NOT NULL)
  WHERE label <> 'error') WHERE ce > cs AND ce - cs >= 0.2""")
def prj08(spark, sf):
    song = W.partitionBy("song")
    rows = S.intervals_of_boundaries(events(spark, sf).withColumns({"f": F.min("us").over(song), "l": F.max("us").over(song)}), ["song"], "us", ORDER)
    rows = rows.select("event_id", F.when(F.col("label") == "error", "silence").otherwise(F.col("label")).alias("label"), ((F.col("us") - F.col("f")) / 1e6).alias("start"), ((F.col("end") - F.col("f")) / 1e6).alias("end"), ((F.col("l") - F.col("f")) / 1e6 - 1).alias("duration"))
    return R.cut_plan(rows, pad=0.5).select("event_id", F.round("clip_start", 6).alias("clip_start"), F.round("clip_end", 6).alias("clip_end"))


@query("prj13_explode", "SELECT l_orderkey, (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1)::INTEGER AS pos, l_linenumber, l_partkey FROM lineitem")
def prj13(spark, sf):
    songs = G.segments_per_song(table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber", ["l_partkey", "l_suppkey"], ["l_linenumber", "l_partkey"], "segments")
    return R.segments_of(songs, "segments", ["l_orderkey"])


@query("prj14_intervals", """
SELECT event_id, song, us, "end" FROM (SELECT *, lead(us) OVER (PARTITION BY song ORDER BY us, event_id) AS "end" FROM {events}) WHERE "end" IS NOT NULL""")
def prj14(spark, sf):
    return S.intervals_of_boundaries(events(spark, sf), ["song"], "us", ORDER).select("event_id", "song", "us", "end")


@query("prj06_duration", "SELECT doc_id, coalesce(nullif(CASE WHEN doc_id % 3 = 0 THEN 0.0 ELSE n_chars::DOUBLE END, 0), nullif((doc_id % 2)::DOUBLE, 0), 7.5) AS duration FROM documents")
def prj06(spark, sf):
    ends = F.array(F.struct(F.lit(1.0).alias("end")), F.struct(F.lit(7.5).alias("end")))
    return table(spark, sf, "documents").select("doc_id", R.duration_of(F.when(F.col("doc_id") % 3 == 0, 0).otherwise(F.col("n_chars")), F.col("doc_id") % 2, ends).alias("duration"))


@query("prj12_chords", "SELECT song, string_agg(label, ' ' ORDER BY us, event_id) AS progression FROM {events} WHERE label <> 'error' GROUP BY song")
def prj12(spark, sf):
    chords = events(spark, sf).groupBy("song").agg(F.array_sort(F.collect_list(F.struct("us", "event_id", F.when(F.col("label") == "error", "N").otherwise(F.col("label")).alias("chord")))).alias("v"))
    return chords.select("song", F.array_join(F.transform(F.filter("v", lambda c: c["chord"] != "N"), lambda c: c["chord"]), " ").alias("progression")).filter("progression <> ''")


@query("ag01_song_array", "SELECT song, count(*) AS n, string_agg(label || '@' || us, ',' ORDER BY us, event_id) AS segments FROM {events} GROUP BY song")
def ag01(spark, sf):
    songs = G.segments_per_song(events(spark, sf), "song", "us", ["event_id"], ["label", "us"])
    return songs.select("song", F.size("song_structure_info").cast("long").alias("n"), F.array_join(F.transform("song_structure_info", lambda s: F.concat(s["label"], F.lit("@"), s["us"].cast("string"))), ",").alias("segments"))


@query("ag04_counters", "SELECT count(*) FILTER (value > 50) AS ok, count(*) FILTER (NOT value > 50) AS failed, round(sum(value) FILTER (value > 50), 2) AS total_duration, count(*) AS rows FROM events")
def ag04(spark, sf):
    return G.run_counters(events(spark, sf), F.col("value") > 50, "value").withColumn("total_duration", F.round("total_duration", 2))


@query("ag05_status_domain", "SELECT s AS label, (SELECT count(*) FROM events WHERE event_type = s) AS n FROM (SELECT unnest(['click', 'view', 'purchase', 'paused']) AS s)")
def ag05(spark, sf):
    return G.status_counts(events(spark, sf), "label", ["click", "view", "purchase", "paused"])


@query("ag07_bpm", """
SELECT song, round(60.0 / avg(CASE WHEN d > 0.1 AND d < 300000.0 THEN d END), 8) AS bpm, count(*) FILTER (d > 0.1 AND d < 300000.0) AS n_intervals
FROM (SELECT song, t - lag(t) OVER (PARTITION BY song ORDER BY us, event_id) AS d FROM {events}) GROUP BY song""")
def ag07(spark, sf):
    return G.tempo(events(spark, sf), ["song"], "t", ORDER, 0.1, 300000.0).withColumn("bpm", F.round("bpm", 8))


@query("ag08_summary", """
SELECT song, round(coalesce(avg(v), 0), 6) AS mean, round(coalesce(median(v), 0), 6) AS median, count(v) AS n_voiced FROM (SELECT song, CASE WHEN value > 20 THEN value END AS v FROM {events}) GROUP BY song""")
def ag08(spark, sf):
    rows = events(spark, sf).withColumn("v", F.when(F.col("value") > 20, F.col("value")).otherwise(0.0))
    return G.voiced_summary(rows, ["song"], "v").select("song", F.round("mean", 6).alias("mean"), F.round("median", 6).alias("median"), "n_voiced")


@query("ag09_segment_argmax", """
WITH m AS (SELECT label, "at", avg(x) AS mean FROM (SELECT label, generate_subscripts(embedding, 1) - 1 AS "at", unnest(embedding)::DOUBLE AS x FROM embeddings) GROUP BY label, "at")
SELECT label, "at"::BIGINT AS best, round(mean, 6) AS mean FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY mean DESC, "at") AS r FROM m) WHERE r = 1""")
def ag09(spark, sf):
    return G.argmax_of_means(table(spark, sf, "embeddings"), ["label"], "embedding").withColumn("mean", F.round("mean", 6))


@query("ag10_agreement", """
WITH a AS (SELECT song, us AS t, (us // 3600000000) % 3 AS label FROM {events} WHERE label = 'view'), b AS (SELECT song, us AS t, (us // 7200000000) % 3 AS label FROM {events} WHERE label = 'click'),
l AS (SELECT song, greatest(x.lo, y.lo) AS lo, least(x.hi, y.hi) AS hi FROM (SELECT song, min(t) AS lo, max(t) AS hi FROM a GROUP BY song) x JOIN (SELECT song, min(t) AS lo, max(t) AS hi FROM b GROUP BY song) y USING (song) WHERE greatest(x.lo, y.lo) < least(x.hi, y.hi)),
p AS (SELECT DISTINCT song, t FROM (SELECT song, t FROM a UNION ALL SELECT song, t FROM b UNION ALL SELECT song, lo FROM l UNION ALL SELECT song, hi FROM l) JOIN l USING (song) WHERE t BETWEEN lo AND hi),
s AS (SELECT song, t, lead(t) OVER (PARTITION BY song ORDER BY t) AS e FROM p),
j AS (SELECT s.song, s.t, s.e, a.label AS la FROM s ASOF LEFT JOIN a ON s.song = a.song AND s.t >= a.t WHERE s.e IS NOT NULL),
k AS (SELECT j.*, b.label AS lb FROM j ASOF LEFT JOIN b ON j.song = b.song AND j.t >= b.t)
SELECT song, round(sum(CASE WHEN la = lb THEN e - t ELSE 0 END) / sum(e - t), 6) AS agreement FROM k GROUP BY song""")
def ag10(spark, sf):
    e = events(spark, sf)
    track = lambda label, hours: e.filter(F.col("label") == label).select("song", F.col("us").alias("time"), (F.floor(F.col("us") / (hours * 3600000000)) % 3).alias("state"))
    return G.agreement(track("view", 1), track("click", 2), ["song"], "time", "state").withColumn("agreement", F.round("agreement", 6))


@query("ag11_bucket_union", """
WITH e AS (SELECT song, label, (us - min(us) OVER (PARTITION BY song)) / 3.6e9 AS t, us, event_id FROM {events}), m AS (SELECT *, coalesce(lead(t) OVER (PARTITION BY song ORDER BY us, event_id), max(t) OVER (PARTITION BY song) + 1) AS e, max(t) OVER (PARTITION BY song) + 1 AS mx FROM e),
w AS (SELECT *, greatest(5.0::DOUBLE, least(30.0::DOUBLE, mx / 30.0::DOUBLE)) AS w FROM m), n AS (SELECT *, greatest(1, floor(mx / w) + 1) AS n FROM w),
b AS (SELECT song, label, w, mx, n, unnest(range(floor(t / w)::BIGINT, greatest(floor(t / w), least(floor(e / w), n - 1))::BIGINT + 1)) AS b FROM n),
s AS (SELECT song, b, w, mx, string_agg(DISTINCT label, ', ' ORDER BY label) AS names FROM b WHERE b < n GROUP BY song, b, w, mx),
r AS (SELECT *, sum(new) OVER (PARTITION BY song ORDER BY b) AS run FROM (SELECT *, CASE WHEN names = lag(names) OVER (PARTITION BY song ORDER BY b) THEN 0 ELSE 1 END AS new FROM s))
SELECT song, names, round(min(b * w), 5) AS start, round(max(least((b + 1) * w, mx)), 5) AS "end", count(*) AS n FROM r GROUP BY song, run, names""")
def ag11(spark, sf):
    song = W.partitionBy("song")
    e = events(spark, sf).withColumn("time", (F.col("us") - F.min("us").over(song)) / 3.6e9).withColumn("max_t", F.max("time").over(song) + 1)
    e = S.spans_of_changes(e, ["song"], "time", ORDER, F.col("max_t"))
    return G.bucket_union(e, ["song"], "time", "end", "label", F.col("max_t")).select("song", "names", F.round("start", 5).alias("start"), F.round("end", 5).alias("end"), "n")


@query("ag12_overlap_add", """
SELECT label, frame, round(sum(x) / greatest(count(x), 1), 6) AS value FROM (SELECT label, vec_id % 5 + generate_subscripts(embedding, 1) - 1 AS frame, unnest(embedding)::DOUBLE AS x FROM embeddings) GROUP BY label, frame""")
def ag12(spark, sf):
    frames = table(spark, sf, "embeddings").select("label", "vec_id", F.posexplode("embedding").alias("i", "x")).select("label", (F.col("vec_id") % 5 + F.col("i")).alias("frame"), F.col("x").cast("double").alias("x"))
    return G.overlap_add(frames, ["label"], "frame", "x").withColumn("value", F.round("value", 6))


@query("ag14_masked_mean", "SELECT user_id AS song, round(avg(value) FILTER (event_type <> 'error'), 6) AS mean FROM events GROUP BY user_id")
def ag14(spark, sf):
    return G.masked_mean(events(spark, sf).withColumn("mask", F.col("label") != "error"), ["song"], "value", "mask").withColumn("mean", F.round("mean", 6))


@query("ag15_hit_rate")
def ag15(spark, sf):
    e = events(spark, sf).withColumn("h", F.col("us") / 3.6e9)
    return G.boundary_hit_rate(e.filter("label = 'view'"), e.filter("label = 'click'"), ["song"], "h", 0.5)


@query("fn06_chars_per_second", "SELECT doc_id, round(length(trim(text, E' \\n\\t\\r')) / greatest(doc_id % 7, 0.001), 6) AS cps FROM documents")
def fn06(spark, sf):
    from cadenza.functions.text import chars_per_second

    return table(spark, sf, "documents").select("doc_id", F.round(chars_per_second(F.col("text"), (F.col("doc_id") % 7).cast("double")), 6).alias("cps"))


@query("wn12_strict_maxima", """
SELECT event_id, CASE WHEN value > max(value) OVER (w ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AND value > max(value) OVER (w ROWS BETWEEN 1 FOLLOWING AND 20 FOLLOWING) THEN value ELSE 0.0 END AS maximum
FROM {events} WINDOW w AS (PARTITION BY song ORDER BY us, event_id)""".replace("(w ROWS", "(PARTITION BY song ORDER BY us, event_id ROWS").replace(" WINDOW w AS (PARTITION BY song ORDER BY us, event_id)", ""))
def wn12(spark, sf):
    return S.strict_maxima(events(spark, sf), ["song"], "value", ORDER).select("event_id", "maximum")


@query("prj12_chords", "SELECT song, string_agg(label, ' ' ORDER BY us, event_id) AS progression, count(*) AS n FROM {events} WHERE label <> 'error' GROUP BY song")
def prj12(spark, sf):
    rows = events(spark, sf).groupBy("song").agg(F.array_sort(F.collect_list(F.struct("us", "event_id", F.when(F.col("label") == "error", "N").otherwise(F.col("label")).alias("chord")))).alias("v"))
    found = R.chord_progression(F.transform("v", lambda x: F.struct(x["chord"].alias("chord"), (x["us"] / 1e6).alias("timestamp"))))
    return rows.select("song", found.alias("c")).filter(F.size("c.values") > 0).select("song", F.array_join("c.progression", " ").alias("progression"), F.size("c.values").cast("long").alias("n"))


@query("prj15_stored_rows", "SELECT event_id FROM events WHERE event_type <> 'error' AND value >= 1")
def prj15(spark, sf):
    rows = events(spark, sf).withColumns({"a_error": F.when(F.col("label") == "error", "bad").when(F.col("event_id") % 2 == 0, ""), "b_error": F.when(F.col("value") < 1, "low")})
    return R.storable_rows(rows, ["a_error", "b_error"]).select("event_id")


def _tracks(spark, sf):
    """Two label tracks of a song, in hours: all labels, and those of every third event, with ends after the last."""
    e = events(spark, sf).withColumn("h", F.floor(F.col("us") / 3.6e8) / 10.0)
    e = e.groupBy("song", "h").agg(F.max_by("label", "event_id").alias("label"), F.max("event_id").alias("event_id"))
    return e.select("song", "h", "label"), e.filter("event_id % 3 = 0").select("song", "h", "label")


@query("ag15_structure", """
WITH e AS (SELECT song, floor(us / 3.6e8) / 10.0 AS h, arg_max(label, event_id) AS label, max(event_id) AS id FROM {events} GROUP BY ALL), a AS (SELECT song, h, label FROM e), b AS (SELECT song, h, label FROM e WHERE id % 3 = 0),
lim AS (SELECT song, greatest(la, lb) AS lo, least(ha, hb) AS hi FROM (SELECT song, min(h) AS la, max(h) AS ha FROM a GROUP BY song) JOIN (SELECT song, min(h) AS lb, max(h) AS hb FROM b GROUP BY song) USING (song) WHERE greatest(la, lb) < least(ha, hb)),
f AS (SELECT song, unnest(range(ceil(lo / 0.5)::BIGINT, ceil(hi / 0.5)::BIGINT)) * 0.5::DOUBLE AS h FROM lim),
x AS (SELECT f.song, a.label AS la, b.label AS lb FROM f ASOF JOIN a ON f.song = a.song AND f.h >= a.h ASOF JOIN b ON f.song = b.song AND f.h >= b.h),
c AS (SELECT song, la, lb, count(*)::DOUBLE AS n FROM x GROUP BY ALL), t AS (SELECT song, sum(n) AS n FROM c GROUP BY song), ra AS (SELECT song, la, sum(n) AS n FROM c GROUP BY ALL), rb AS (SELECT song, lb, sum(n) AS n FROM c GROUP BY ALL),
s AS (SELECT song, (SELECT sum(n * (n - 1) / 2) FROM c WHERE c.song = t.song) AS both_, (SELECT sum(n * (n - 1) / 2) FROM ra WHERE ra.song = t.song) AS in_a, (SELECT sum(n * (n - 1) / 2) FROM rb WHERE rb.song = t.song) AS in_b,
  (SELECT -sum(c.n / t.n * log2(c.n / rb.n)) FROM c JOIN rb USING (song, lb) WHERE c.song = t.song) AS hab, (SELECT -sum(c.n / t.n * log2(c.n / ra.n)) FROM c JOIN ra USING (song, la) WHERE c.song = t.song) AS hba,
  (SELECT log2(count(*)) FROM ra WHERE ra.song = t.song) AS za, (SELECT log2(count(*)) FROM rb WHERE rb.song = t.song) AS zb FROM t),
p AS (SELECT song, CASE WHEN in_b > 0 THEN both_ / in_b ELSE 0 END AS p, CASE WHEN in_a > 0 THEN both_ / in_a ELSE 0 END AS r, CASE WHEN zb > 0 THEN 1 - hba / zb ELSE 0 END AS o, CASE WHEN za > 0 THEN 1 - hab / za ELSE 0 END AS u FROM s)
SELECT song, round(p, 6) AS pw_precision, round(r, 6) AS pw_recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS pw_f, round(o, 6) AS s_over, round(u, 6) AS s_under, round(CASE WHEN o + u > 0 THEN 2 * o * u / (o + u) ELSE 0 END, 6) AS s_f FROM p""")
def ag15_structure(spark, sf):
    a, b = _tracks(spark, sf)
    found = G.structure_scores(a, b, ["song"], "h", "label", 0.5)
    return found.select("song", *[F.round(c, 6).alias(c) for c in ("pw_precision", "pw_recall", "pw_f", "s_over", "s_under", "s_f")])
