"""Queries of the join, set, partitioning and resume operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.operators import joins as J
from cadenza.operators import partitioning as P
from cadenza.operators import resume as Z
from cadenza.plans.registry import events, query, table


@query("jn01_inner", "SELECT l_orderkey, l_linenumber, o_orderstatus FROM lineitem JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'F') o ON l_orderkey = o_orderkey")
def jn01(spark, sf):
    orders = table(spark, sf, "orders").filter("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus", "o_orderdate")
    return J.attach_metadata(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), orders, "l_orderkey", ["o_orderdate"])


@query("jn01_unmatched", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F')")
def jn01_unmatched(spark, sf):
    orders = table(spark, sf, "orders").filter("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return J.unmatched(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), orders, "l_orderkey")


@query("jn02_left_default", "SELECT d.doc_id, coalesce(quality, -1) AS quality FROM documents d LEFT JOIN labels l USING (doc_id)")
def jn02(spark, sf):
    return J.attach_default(table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels"), "doc_id", "quality", F.lit(-1))


@query("jn03_last_wins", "SELECT song, event_id, label FROM (SELECT *, row_number() OVER (PARTITION BY song ORDER BY us DESC, event_id DESC) AS r FROM {events}) WHERE r = 1")
def jn03(spark, sf):
    return J.last_wins(events(spark, sf).select("song", "us", "event_id", "label"), ["song"], ["us", "event_id"]).select("song", "event_id", "label")


def _halves(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    first = docs.select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("lang"), F.when(F.col("doc_id") % 5 != 0, F.col("n_chars")).alias("n"), F.lit(0).alias("ord"))
    second = docs.select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.lit("xx")).alias("lang"), (F.col("n_chars") + F.col("doc_id") % 2).alias("n"), "source", F.lit(1).alias("ord"))
    return [first, second, labels.select("doc_id", "quality", F.lit(2).alias("ord"))]


@query("jn04_keyed_merge", """
WITH r AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN lang END AS lang, CASE WHEN doc_id % 5 <> 0 THEN n_chars END AS n, NULL AS source, NULL AS quality, 0 AS ord FROM documents
  UNION ALL SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'xx' END, n_chars + doc_id % 2, source, NULL, 1 FROM documents UNION ALL SELECT doc_id, NULL, NULL, NULL, quality, 2 FROM labels)
SELECT doc_id, arg_min(lang, ord) FILTER (lang IS NOT NULL) AS lang, arg_min(n, ord) FILTER (n IS NOT NULL) AS n, arg_min(source, ord) FILTER (source IS NOT NULL) AS source, arg_min(quality, ord) FILTER (quality IS NOT NULL) AS quality FROM r GROUP BY doc_id""")
def jn04(spark, sf):
    return J.keyed_merge(_halves(spark, sf), "doc_id", ["ord"])


@query("ag03_conflicts", """
WITH r AS (SELECT doc_id, 'lang' AS field, CASE WHEN doc_id % 2 = 0 THEN lang END AS value, 0 AS ord FROM documents UNION ALL SELECT doc_id, 'lang', CASE WHEN doc_id % 3 = 0 THEN 'xx' END, 1 FROM documents),
k AS (SELECT *, first_value(value) OVER (PARTITION BY doc_id, field ORDER BY ord) AS kept FROM r WHERE value IS NOT NULL)
SELECT field, kept[:200] AS kept, count(*) AS n FROM k WHERE value <> kept GROUP BY ALL ORDER BY n DESC, field, kept LIMIT 10""")
def ag03(spark, sf):
    return J.merge_conflicts([d.select("doc_id", "lang", "ord") for d in _halves(spark, sf)[:2]], "doc_id", ["ord"])


@query("jn05_partitioned_lookup", "SELECT l_orderkey, l_linenumber, p_brand, s_name FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey WHERE p_size > 10")
def jn05(spark, sf):
    pairs = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return pairs.join(table(spark, sf, "part").filter("p_size > 10").select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey").join(table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name"), "l_suppkey").select("l_orderkey", "l_linenumber", "p_brand", "s_name")


@query("jn06_overlap", """
WITH a AS (SELECT event_id, song, t AS s, t + value * 60 AS e FROM {events} WHERE label = 'view'), b AS (SELECT event_id AS id_r, song, t AS s2, t + value * 60 AS e2 FROM {events} WHERE label = 'click')
SELECT a.song, event_id, id_r FROM a JOIN b ON a.song = b.song AND least(e, e2) - greatest(s, s2) >= 0.02""")
def jn06(spark, sf):
    e = events(spark, sf).withColumn("stop", F.col("t") + F.col("value") * 60)
    a = e.filter("label = 'view'").select("song", "event_id", F.col("t").alias("start"), F.col("stop").alias("end"))
    b = e.filter("label = 'click'").select("song", F.col("event_id").alias("id_r"), F.col("t").alias("start_r"), F.col("stop").alias("end_r"))
    return J.overlap_join(a, b, ["song"], 0.02, 3600.0).select("song", "event_id", "id_r")


@query("jn07_point_in_interval", """
WITH s AS (SELECT song, event_id AS span, us, lead(us) OVER (PARTITION BY song ORDER BY us, event_id) AS e FROM {events} WHERE label = 'view')
SELECT p.event_id, s.span FROM {events} p JOIN s ON p.song = s.song AND p.us >= s.us AND p.us < s.e WHERE p.label = 'click'""")
def jn07(spark, sf):
    from cadenza.operators.sequences import intervals_of_boundaries

    e = events(spark, sf)
    spans = intervals_of_boundaries(e.filter("label = 'view'"), ["song"], "us", ["us", "event_id"]).select("song", F.col("event_id").alias("span"), F.col("us").alias("start"), "end")
    return J.points_in_intervals(e.filter("label = 'click'").select("song", "event_id", "us"), spans, ["song"], "us", "start", "end", 86400e6).select("event_id", "span")


@query("jn08_asof", """
SELECT p.event_id, v.event_id AS value_asof FROM (SELECT * FROM {events} WHERE label = 'purchase') p ASOF LEFT JOIN (SELECT * FROM {events} WHERE label = 'view') v ON p.song = v.song AND p.us >= v.us""")
def jn08(spark, sf):
    e = events(spark, sf).select("song", "us", "event_id")
    e = events(spark, sf).select("song", "us", "event_id", "label")
    right = e.filter("label = 'view'").select("song", "us", "event_id", F.col("event_id").alias("value"))
    return J.asof_join(e.filter("label = 'purchase'"), right, ["song"], "us", "value", "event_id").select("event_id", "value_asof")


@query("jn09_anti", "SELECT doc_id FROM documents ANTI JOIN labels USING (doc_id)")
def jn09(spark, sf):
    return J.remaining(table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels"), ["doc_id"])


@query("jn10_merge_back", "SELECT d.doc_id, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id)")
def jn10(spark, sf):
    return J.merge_back(table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels"), "doc_id")


@query("jn11_semi", "SELECT doc_id FROM documents SEMI JOIN labels USING (doc_id)")
def jn11(spark, sf):
    return J.finished(table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels"), ["doc_id"])


@query("jn12_dimension", "SELECT c_custkey, n_name, n_regionkey IN (1, 3) AS allowed FROM customer JOIN nation ON c_nationkey = n_nationkey")
def jn12(spark, sf):
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", F.col("n_regionkey").isin(1, 3).alias("allowed"))
    return table(spark, sf, "customer").select("c_custkey", "c_nationkey").join(nation, "c_nationkey").select("c_custkey", "n_name", "allowed")


@query("so01_union_all", "SELECT c_custkey AS id, 'c' AS kind, c_acctbal AS bal FROM customer UNION ALL SELECT s_suppkey, 's', s_acctbal FROM supplier")
def so01(spark, sf):
    a = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.lit("c").alias("kind"), F.col("c_acctbal").alias("bal"))
    return a.unionByName(table(spark, sf, "supplier").select(F.col("s_acctbal").alias("bal"), F.col("s_suppkey").alias("id"), F.lit("s").alias("kind")), allowMissingColumns=True)


@query("so02_union_distinct", "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def so02(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_nationkey").alias("k")).union(table(spark, sf, "supplier").select("s_nationkey")).distinct()


@query("so03_except", "SELECT o_custkey AS k FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_acctbal > 0")
def so03(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_custkey").alias("k")).subtract(table(spark, sf, "customer").filter("c_acctbal > 0").select("c_custkey"))


@query("so04_distinct", "SELECT DISTINCT lang, source FROM documents")
def so04(spark, sf):
    return table(spark, sf, "documents").select("lang", "source").distinct()


@query("so05_intersect", "SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def so05(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_nationkey").alias("k")).intersect(table(spark, sf, "supplier").select("s_nationkey"))


@query("st01_total_order", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey")
def st01(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy("o_orderkey")


@query("st05_offset_limit", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 100")
def st05(spark, sf):
    return P.ordered_slice(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 100, 50)


@query("st06_shards", "SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 64 AS shard FROM documents")
def st06(spark, sf):
    return P.shards(table(spark, sf, "documents").select("doc_id"), "doc_id", 64, target=300).select("doc_id", "shard")


@query("st07_split", "SELECT doc_id, ntile(7) OVER (ORDER BY doc_id) - 1 AS rank FROM documents")
def st07(spark, sf):
    return P.balanced_ranks(table(spark, sf, "documents").select("doc_id"), "doc_id", 7).select("doc_id", "rank")


@query("st08_split_last", "SELECT doc_id, least((row_number() OVER (ORDER BY doc_id) - 1) // ((SELECT count(*) FROM documents) // 7), 6) AS rank FROM documents")
def st08(spark, sf):
    return P.ranks_rest_last(table(spark, sf, "documents").select("doc_id"), "doc_id", 7).select("doc_id", "rank")


@query("st09_stride", "SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) % 4 AS rank FROM documents")
def st09(spark, sf):
    return P.strided(table(spark, sf, "documents").select("doc_id"), "doc_id", 4).select("doc_id", "rank")


@query("st10_concatenation", "SELECT doc_id, md5(text) AS m FROM documents WHERE trim(text) <> ''")
def st10(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return docs.filter("doc_id % 2 = 0").unionByName(docs.filter("doc_id % 2 = 1")).filter("trim(text) <> ''").select("doc_id", F.md5("text").alias("m"))


@query("st11_micro_batches", "SELECT (row_number() OVER (ORDER BY doc_id) - 1) // 100 AS batch, doc_id FROM documents")
def st11(spark, sf):
    return P.shards(table(spark, sf, "documents").select("doc_id"), "doc_id", 100).select(F.col("shard").alias("batch"), "doc_id")


@query("st12_shuffle", "SELECT doc_id, row_number() OVER (ORDER BY md5('7:' || doc_id)) AS place FROM documents")
def st12(spark, sf):
    mixed = P.shuffled(table(spark, sf, "documents").select("doc_id", F.md5(F.concat(F.lit("7:"), F.col("doc_id").cast("string"))).alias("h")), F.col("doc_id"), 7)
    return P.row_numbers(mixed, "h", target=300).select("doc_id", F.col("rn").alias("place"))


@query("st15_first_dedupe", "SELECT doc_id, md5(text) AS text_md5 FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS r FROM documents) WHERE r = 1")
def st15(spark, sf):
    return P.first_occurrences(table(spark, sf, "documents").select(F.md5("text").alias("text_md5"), "doc_id"), ["text_md5"], ["doc_id"]).select("doc_id", "text_md5")


@query("src14_hex_shards", "SELECT 'segment_' || lpad(lower(to_hex(i)), 2, '0') || '.lance' AS name FROM range(256) t(i)")
def src14(spark, sf):
    return spark.range(1).select(F.explode(P.shard_names()).alias("name"))


@query("rs01_done_keys", "SELECT event_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND value > 60)")
def rs01(spark, sf):
    e = events(spark, sf)
    return J.remaining(e, e.filter("label = 'error' AND value > 60"), ["song"]).select("event_id")


@query("rs02_latest_success", """
SELECT DISTINCT user_id AS song FROM events WHERE user_id NOT IN (SELECT song FROM (SELECT song, label, row_number() OVER (PARTITION BY song ORDER BY us DESC, event_id DESC) AS r FROM {events}) WHERE r = 1 AND label <> 'error')""")
def rs02(spark, sf):
    e = events(spark, sf)
    return Z.to_retry(e.select("song").distinct(), e.select("song", "us", "event_id", "label"), ["song"], ["us", "event_id"], F.col("label") != "error")


def _log(spark, sf):
    e = events(spark, sf)
    meta = e.filter("label = 'signup'").select((F.col("event_id") % 500).alias("total_tasks"), (F.col("us") * 1.0 + F.col("event_id") / 1e6).alias("timestamp"))
    return meta.unionByName(e.filter("label = 'click'").select(F.col("song").alias("task_id"), F.col("us").cast("double").alias("timestamp")), allowMissingColumns=True)


@query("rs05_progress", """
SELECT total, completed, greatest(total - completed, 0) AS unallocated FROM (SELECT (SELECT event_id % 500 FROM {events} WHERE label = 'signup' ORDER BY us DESC, event_id DESC LIMIT 1) AS total, (SELECT count(DISTINCT user_id) FROM events WHERE event_type = 'click') AS completed)""")
def rs05(spark, sf):
    return Z.progress(_log(spark, sf))


@query("rs06_states", "SELECT song, CASE label WHEN 'error' THEN 'unallocated' ELSE label END AS label FROM (SELECT *, row_number() OVER (PARTITION BY song ORDER BY us DESC, event_id DESC) AS r FROM {events}) WHERE r = 1")
def rs06(spark, sf):
    return Z.task_states(events(spark, sf), "song", "label", ["us", "event_id"], reset="error")


@query("rs07_next_n", "SELECT doc_id FROM documents ANTI JOIN labels USING (doc_id) ORDER BY doc_id LIMIT 20")
def rs07(spark, sf):
    return Z.next_tasks(table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels"), "doc_id", 20)


@query("rs08_shards_done", "SELECT o_custkey AS shard FROM (SELECT o_custkey, count(*) AS i, count(*) FILTER (o_orderstatus <> 'F') AS o FROM orders GROUP BY o_custkey) WHERE o >= i")
def rs08(spark, sf):
    manifest = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("shard")).agg(F.count(F.lit(1)).alias("i"), F.count_if(F.col("o_orderstatus") != "F").alias("o"))
    return Z.finished_shards(manifest, "i", "o").select("shard")
