"""Queries of the text, hash, array, prompt and source functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from cadenza import schemas
from cadenza.functions import arrays as A
from cadenza.functions import sampling as H
from cadenza.functions import text as X
from cadenza.operators import aggregates as G
from cadenza.operators import prompts as M
from cadenza.operators import quality as Q
from cadenza.operators import reshape as R
from cadenza.plans.registry import events, query, table
from cadenza.sources import jsonl, media, sinks

_STRIP = "regexp_replace(%s, '^[\\s\\x1c-\\x1f]+|[\\s\\x1c-\\x1f]+$', '', 'g')"
_BODY = _STRIP % "text"


def _docs(spark, sf):
    return table(spark, sf, "documents")


@query("src04_path_fallback", "SELECT page_id, CASE WHEN page_id % 3 = 0 THEN NULL ELSE url END AS path FROM pages")
def src04(spark, sf):
    record = F.when(F.col("page_id") % 3 == 0, F.create_map(F.lit("audio_path"), F.lit(None).cast("string"), F.lit("url"), F.col("url"))).otherwise(F.create_map(F.lit("path"), F.lit("later"), F.lit("url"), F.col("url")))
    return table(spark, sf, "pages").select("page_id", jsonl.record_path(record).alias("path"))


@query("src05_audio_fallback", "SELECT page_id, CASE WHEN page_id % 2 = 0 THEN url ELSE 'p' END AS path FROM pages")
def src05(spark, sf):
    record = F.when(F.col("page_id") % 2 == 0, F.create_map(F.lit("url"), F.lit("no"), F.lit("prompt"), F.col("url"))).otherwise(F.create_map(F.lit("path"), F.lit("p"), F.lit("file"), F.lit("f")))
    return table(spark, sf, "pages").select("page_id", jsonl.record_path(record, jsonl.AUDIO_PATHS).alias("path"))


@query("src06_segment_metadata", "SELECT l_orderkey, l_linenumber, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag <> 'A'")
def src06(spark, sf):
    segments = table(spark, sf, "lineitem").select(F.col("l_linenumber").alias("start"), F.col("l_quantity").alias("end"), F.when(F.col("l_returnflag") != "A", "s").alias("subset_name"), F.col("l_orderkey").alias("oid"), "l_orderkey", "l_linenumber")
    metadata = table(spark, sf, "orders").select(F.lit("s").alias("subset_name"), F.col("o_orderkey").alias("oid"), "o_custkey")
    return media.segments_with_metadata(segments, metadata).select("l_orderkey", "l_linenumber", "o_custkey")


@query("src07_columnar_scan", "SELECT o_orderkey, o_totalprice, (row_number() OVER (ORDER BY o_orderkey) - 1) // 64 AS batch FROM (SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 1000 OFFSET 100)")
def src07(spark, sf):
    return media.open_reader(spark, "pq", f"{sf}/orders.parquet", columns=["o_orderkey", "o_totalprice"], order=["o_orderkey"], offset=100, limit=1000, batch=64)


@query("src09_media_ext", """
SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS name, lower(regexp_extract(regexp_extract(url, '([^/]*)$', 1), '[^/.][^/]*?(\\.[^./]+)$', 1)) AS suffix,
  CASE page_id % 4 WHEN 0 THEN 'audio' WHEN 1 THEN 'video' ELSE NULL END AS kind FROM pages""")
def src09(spark, sf):
    path = F.concat(F.col("url"), F.element_at(F.array(*[F.lit(x) for x in ("/a.MP3", "/b.mkv", "/.c.mp3", "/d.txt")]), (F.col("page_id") % 4 + 1).cast("int")))
    return table(spark, sf, "pages").select("page_id", X.file_name(F.col("url")).alias("name"), X.path_suffix(F.col("url")).alias("suffix"), media.media_kind(path).alias("kind"))


@query("src10_valid_duration", "SELECT event_id FROM events WHERE value - 50 > 0")
def src10(spark, sf):
    return events(spark, sf).filter(media.valid_duration(F.col("value") - 50)).select("event_id")


@query("src15_known_and_rest", """SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '{"source":"' || source || '"}' ELSE '{"lang":"' || lang || '","source":"' || source || '"}' END AS extra FROM documents""")
def src15(spark, sf):
    return jsonl.known_and_rest(_docs(spark, sf).select("doc_id", F.when(F.col("doc_id") % 3 != 0, F.col("lang")).alias("lang"), "source", F.lit(b"x").alias("raw")), ["doc_id"])


@query("src16_has_location", "SELECT doc_id FROM documents WHERE doc_id % 5 <> 0 OR doc_id % 3 = 0")
def src16(spark, sf):
    five, three = F.col("doc_id") % 5 == 0, F.col("doc_id") % 3 == 0
    return _docs(spark, sf).filter(jsonl.has_location(F.when(~five, "p").otherwise(""), F.lit(None).cast("string"), F.lit(None).cast("binary"), F.when(three, "b"), F.lit("k"))).select("doc_id")


@query("src17_valid_segment", "SELECT doc_id FROM labels WHERE quality = 1")
def src17(spark, sf):
    return table(spark, sf, "labels").filter(media.valid_segment(F.col("doc_id"), F.col("toxic"), F.lit("s"), F.when(F.col("quality") == 1, "o"))).select("doc_id")


@query("src18_bucket_key", "SELECT page_id, regexp_extract(url, '^[a-z]+://([^/]*)/(.+)$', 1) AS bucket, regexp_extract(url, '^[a-z]+://([^/]*)/(.+)$', 2) AS key FROM pages")
def src18(spark, sf):
    return table(spark, sf, "pages").select("page_id", media.bucket_and_key(media.rewrite_prefix(F.col("url"), "https://", "s3://")).alias("x")).select("page_id", "x.*")


@query("snk03_bad_segments", "SELECT user_id::VARCHAR AS audio_path, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY user_id")
def snk03(spark, sf):
    songs = G.segments_per_song(events(spark, sf).withColumn("reasons", F.when(F.col("label") == "error", F.array(F.lit("e"))).otherwise(F.array().cast("array<string>"))), "song", "us", ["event_id"], ["event_id", "reasons"])
    bad = sinks.bad_segments(songs.select(F.col("song").cast("string").alias("audio_path"), "song_structure_info"), "song_structure_info", "reasons")
    return bad.groupBy("audio_path").agg(F.count(F.lit(1)).alias("n"))


@query("snk05_storable", "SELECT page_id, html AS kept, {'a': page_id, 'd': [{'e': page_id + 1}]}::VARCHAR AS deep, 'page_id,html,deep' AS columns FROM pages")
def snk05(spark, sf):
    raw = F.lit(b"1")
    deep = F.struct(F.col("page_id").alias("a"), raw.alias("b"), F.struct(raw.alias("c")).alias("bb"), F.array(F.struct((F.col("page_id") + 1).alias("e"), raw.alias("f"))).alias("d"), F.array(raw).alias("g"))
    out = sinks.storable(table(spark, sf, "pages").select("page_id", "html", "url", F.lit("x").alias("secret_key"), raw.alias("audio_bytes"), raw.alias("other"), deep.alias("deep")))
    said = F.format_string("{'a': %d, 'd': [{'e': %d}]}", "deep.a", F.element_at("deep.d", 1)["e"])
    fields = sum(len(x.names) for x in (out.schema["deep"].dataType, out.schema["deep"].dataType["d"].dataType.elementType))
    return out.select("page_id", F.col("html").alias("kept"), (said if fields == 3 else F.lit("bytes left")).alias("deep"), F.lit(",".join(out.columns)).alias("columns"))


@query("prj03_default_text", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN lang ELSE '' END AS asr_text FROM documents")
def prj03(spark, sf):
    v = F.array(F.struct(F.col("doc_id").alias("id"), F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("asr_text")))
    return _docs(spark, sf).select("doc_id", F.element_at(R.with_default_text(v), 1)["asr_text"].alias("asr_text"))


@query("prj05_first_filled", "SELECT doc_id, coalesce(nullif(CASE WHEN doc_id % 2 = 0 THEN '' ELSE lang END, ''), source) AS x FROM documents")
def prj05(spark, sf):
    return _docs(spark, sf).select("doc_id", R.first_filled(F.when(F.col("doc_id") % 2 == 0, "").otherwise(F.col("lang")), F.col("source")).alias("x"))


@query("prj09_clip_name", "SELECT doc_id, source || '__a_b_' || '1.000_2.500-' || md5('/x/' || source || '.mp3')[:8] || '.flac' AS name FROM documents")
def prj09(spark, sf):
    return _docs(spark, sf).select("doc_id", R.clip_name(F.concat(F.lit("/x/"), F.col("source"), F.lit(".mp3")), F.lit("a/b"), F.lit(1.0), F.lit(2.5), "flac").alias("name"))


@query("prj10_label_filter", "SELECT event_id FROM events WHERE event_type NOT IN ('error', 'signup')")
def prj10(spark, sf):
    return R.without_labels(events(spark, sf), "label", ["Error", "signup"]).select("event_id")


@query("ag06_char_hist", f"""
WITH t AS (SELECT doc_id, {_BODY} AS t FROM documents), c AS (SELECT doc_id, count(*) AS d, max(n) AS m, sum(n) AS l FROM (SELECT doc_id, ch, count(*) AS n FROM (SELECT doc_id, unnest(string_split(t, '')) AS ch FROM t) GROUP BY doc_id, ch) GROUP BY doc_id)
SELECT doc_id, round(d / l, 6) AS unique_ratio, round(m / l, 6) AS max_ratio FROM c""")
def ag06(spark, sf):
    profile = X.char_profile(F.col("text"))
    return _docs(spark, sf).select("doc_id", F.round(X.unique_char_ratio(profile), 6).alias("unique_ratio"), F.round(X.max_char_ratio(profile), 6).alias("max_ratio"))


@query("ag13_line_counts", "SELECT lang, count(*) AS lines, count(*) FILTER (trim(line) <> '') AS filled FROM (SELECT lang, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY lang")
def ag13(spark, sf):
    docs = _docs(spark, sf)
    parts = [G.line_counts(docs.filter(F.col("lang") == r["lang"]), "text").withColumn("lang", F.lit(r["lang"])) for r in docs.select("lang").distinct().collect()]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("fn01_normalize", f"SELECT doc_id, md5(CASE WHEN t IN ('NO_LYRICS_DETECTED', '[Inaudible]') THEN '' ELSE t END) AS t FROM (SELECT doc_id, {_STRIP % "CASE doc_id % 5 WHEN 1 THEN ' NO_LYRICS_DETECTED ' WHEN 2 THEN '[Inaudible]' WHEN 3 THEN NULL ELSE chr(9) || text || chr(10) END"} AS t FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents WHERE doc_id % 5 <> 3 UNION ALL SELECT doc_id, '' FROM documents WHERE doc_id % 5 = 3)) WHERE t IS NOT NULL UNION ALL SELECT doc_id, md5('') FROM documents WHERE doc_id % 5 = 3")
def fn01(spark, sf):
    five = F.col("doc_id") % 5
    said = F.when(five == 1, " NO_LYRICS_DETECTED ").when(five == 2, "[Inaudible]").when(five == 3, F.lit(None).cast("string")).otherwise(F.concat(F.lit("\t"), F.coalesce("text", F.lit("")), F.lit("\n")))
    return _docs(spark, sf).select("doc_id", F.md5(X.normalize_transcript(said)).alias("t"))


@query("fn02_tag", "SELECT doc_id, md5(CASE WHEN doc_id % 2 = 0 THEN ltrim(coalesce(text, ''), E' \\n\\t\\r\\f\\x0b') ELSE coalesce(text, '') || ' <|x|>' END) AS t FROM documents")
def fn02(spark, sf):
    text = F.coalesce("text", F.lit(""))
    return _docs(spark, sf).select("doc_id", F.md5(X.strip_language_tag(F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("<|en_x|> "), text)).otherwise(F.concat(text, F.lit(" <|x|>"))))).alias("t"))


@query("fn03_long_run")
def fn03(spark, sf):
    return _docs(spark, sf).select("doc_id", X.has_long_run(F.col("text"), 2).alias("run"))


@query("fn04_repeat")
def fn04(spark, sf):
    return _docs(spark, sf).select("doc_id", Q.repeated_chunk(X.py_strip(F.col("text"))).alias("r")).select("doc_id", "r.*")


_RULES = f"""
WITH t AS (SELECT doc_id, {_BODY} AS t, (doc_id % 300 + 1)::DOUBLE AS dur FROM documents), ch AS (SELECT doc_id, unnest(string_split(t, '')) AS ch, unnest(range(length(t))) AS i FROM t WHERE length(t) > 0),
c AS (SELECT doc_id, count(*) AS d, max(n) AS m FROM (SELECT doc_id, ch, count(*) AS n FROM ch GROUP BY doc_id, ch) GROUP BY doc_id),
r AS (SELECT doc_id, max(n) AS run FROM (SELECT doc_id, count(*) AS n FROM (SELECT doc_id, ch, i - row_number() OVER (PARTITION BY doc_id, ch ORDER BY i) AS island FROM ch WHERE ch <> chr(10)) GROUP BY doc_id, ch, island) GROUP BY doc_id)
SELECT t.doc_id, CASE WHEN length(t) < {{never}} OR length(t) = 0 THEN '' WHEN run > {{run}} THEN 'hard_same_char_run' WHEN length(t) < 200 THEN '' ELSE concat_ws(',', CASE WHEN length(t) / dur > 12 THEN 'speed' END, CASE WHEN d / length(t) < 0.1 THEN 'low_unique' END, CASE WHEN m / length(t) > 0.55 THEN 'max_char_ratio' END) END AS reasons
FROM t LEFT JOIN c USING (doc_id) LEFT JOIN r USING (doc_id)"""


@query("fn07_quality_rules", _RULES.format(never=1000, run=80))
def fn07(spark, sf):
    why = Q.reasons(F.col("text"), (F.col("doc_id") % 300 + 1).cast("double"), Q.Limits())
    return _docs(spark, sf).select("doc_id", F.array_join(why, ",").alias("reasons"))


@query("fn07_hard_runs", _RULES.format(never=1, run=2))
def fn07_hard(spark, sf):
    """Limits at which hard runs and short texts come up."""
    why = Q.reasons(F.col("text"), (F.col("doc_id") % 300 + 1).cast("double"), Q.Limits(never=1, hard_run=2))
    return _docs(spark, sf).select("doc_id", F.array_join(why, ",").alias("reasons"))


@query("fn07_all_rules")
def fn07_all(spark, sf):
    why = Q.reasons(F.col("text"), (F.col("doc_id") % 300 + 1).cast("double"), Q.Limits(), Q.repeated_chunk(X.py_strip(F.col("text"))))
    return _docs(spark, sf).select("doc_id", F.array_join(why, ",").alias("reasons"))


@query("fn08_fix")
def fn08(spark, sf):
    limits = Q.Limits(never=200, repeats=2)
    rows = _docs(spark, sf).select("doc_id", "text", Q.repeated_chunk(X.py_strip(F.col("text"))).alias("stripped"), Q.repeated_chunk(F.col("text")).alias("raw"))
    rows = rows.withColumn("why", Q.reasons(F.col("text"), F.lit(60.0), limits, F.col("stripped")))
    return rows.select("doc_id", F.array_join("why", ",").alias("reasons"), F.md5(Q.fixed(F.col("text"), F.col("why"), F.col("raw"))).alias("fixed_md5"))


@query("fn09_scrub", f"""
SELECT doc_id, CASE WHEN leak THEN 'leak' WHEN t = '' THEN 'empty' ELSE 'ok' END AS status, CASE WHEN NOT leak AND t <> '' THEN md5(t) END AS text_md5
FROM (SELECT doc_id, t, contains(lower(t), '<think>') OR contains(lower(t), '</think>') OR contains(lower(t), 'here''s a thinking process:') AS leak
  FROM (SELECT doc_id, CASE doc_id % 4 WHEN 2 THEN '' WHEN 3 THEN trim({_BODY} || ' <think>') ELSE {_BODY} END AS t FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)))""")
def fn09(spark, sf):
    four, text = F.col("doc_id") % 4, F.coalesce("text", F.lit(""))
    said = F.when(four == 0, text).when(four == 1, F.concat(F.lit("<think>a\nx</think> "), text)).when(four == 2, F.concat(F.lit(" <THINK>"), text, F.lit("</think>"))).otherwise(F.concat(text, F.lit(" <think>")))
    return _docs(spark, sf).select("doc_id", X.scrub_output(said, True).alias("x")).select("doc_id", "x.status", F.md5("x.text").alias("text_md5"))


@query("fn10_prompt_json", f"""SELECT doc_id, CASE WHEN doc_id % 4 < 2 THEN nullif({_BODY}, '') END AS prompt FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)""")
def fn10(spark, sf):
    four, whole = F.col("doc_id") % 4, F.to_json(F.struct(F.coalesce("text", F.lit("")).alias("prompt")))
    said = F.when(four == 0, whole).when(four == 1, F.concat(F.lit("Sure: "), whole, F.lit(" done"))).when(four == 2, F.lit("{}")).otherwise(F.concat(F.lit('{"prompt": '), F.col("doc_id").cast("string"), F.lit("}")))
    return _docs(spark, sf).select("doc_id", X.parse_prompt(said).alias("prompt"))


@query("fn11_norm", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'sections' ELSE 'paragraph' END AS style, CASE WHEN lower(lang) LIKE 'zh%' OR source LIKE 'zh%' THEN 'zh' ELSE 'en' END AS language FROM (SELECT doc_id, lang, CASE WHEN n_chars % 2 = 0 THEN 'zh' ELSE source END AS source FROM documents)")
def fn11(spark, sf):
    style = F.when(F.col("doc_id") % 3 == 0, " Sections ").when(F.col("doc_id") % 3 == 1, F.col("source"))
    language = F.when(F.col("n_chars") % 2 == 0, F.concat(F.lit(" ZH-"), F.col("lang"))).otherwise(F.upper("lang"))
    return _docs(spark, sf).select("doc_id", X.normalize_style(style).alias("style"), X.normalize_language(language).alias("language"))


@query("fn12_hint", "SELECT conv_id, turn, CASE WHEN turn = 0 THEN 'reference' WHEN turn % 3 = 1 THEN '' WHEN regexp_matches(lower(text), 'vocal|singer|singing|lyric|rap|ballad|verse|chorus|hook') THEN 'likely' ELSE '' END AS hint FROM conversations")
def fn12(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", X.vocal_hint(F.col("turn") == 0, F.col("turn") % 3 == 1, F.col("text")).alias("hint"))


@query("fn13_trunc", "SELECT doc_id, md5(CASE WHEN length(text) > 2000 THEN text[:2000] || chr(10) || '[...truncated]' ELSE text END) AS m FROM documents")
def fn13(spark, sf):
    return _docs(spark, sf).select("doc_id", F.md5(X.truncate(F.col("text"))).alias("m"))


@query("fn14_segment_pack", "SELECT conv_id, string_agg('[' || role || turn || '] [' || turn || '.000] [C major]' || chr(10) || 'lyrics:' || chr(10) || CASE WHEN turn % 2 = 0 THEN 'la' ELSE '(none)' END || chr(10) || chr(10) || 'chord_progression:' || chr(10) || CASE WHEN turn <= 1 THEN CASE turn WHEN 0 THEN 'C G' ELSE 'G' END ELSE 'N/A' END || chr(10) || '[' || (turn + 1) || '.000]' || chr(10), chr(10) ORDER BY turn) AS pack FROM conversations GROUP BY conv_id")
def fn14(spark, sf):
    seg = F.struct("turn", F.concat("role", F.col("turn").cast("string")).alias("segment"), F.col("role").alias("label"), F.col("turn").cast("double").alias("start"), (F.col("turn") + 1).cast("double").alias("end"), F.struct(F.lit("C").alias("key"), F.lit("major").alias("scale")).alias("key"), F.when(F.col("turn") % 2 == 0, " la ").alias("asr_text"))
    rows = table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(seg.withField("turn", F.col("turn"))), lambda a, b: (a["turn"] - b["turn"]).cast("int")).alias("v"))
    chords = F.array(*[F.struct(F.lit(c).alias("chord"), F.lit(t).alias("timestamp")) for c, t in (("C", 0.0), ("C", 0.5), ("G", 0.9), ("G", 1.0))])
    return rows.select("conv_id", M.segment_blocks(F.col("v"), chords).alias("pack"))


@query("fn15_caption_prompt", """
SELECT doc_id, md5('Describe one recording for a listener who can''t hear it yet.' || chr(10) || chr(10) || CASE WHEN doc_id % 2 = 0 THEN 'path:' || chr(10) || '/m/' || source || chr(10) || chr(10) ELSE '' END || 'length in seconds:' || chr(10) || format('{:.6f}', n_chars::DOUBLE / 4) || chr(10) || chr(10)
  || 'first description:' || chr(10) || CASE WHEN coalesce(text, '') <> '' THEN text ELSE 'N/A' END || chr(10) || chr(10) || CASE WHEN doc_id % 3 = 0 THEN 'sections with key, lyrics and chords:' || chr(10) || lang || chr(10) || chr(10) ELSE '' END
  || 'beats in a bar:' || chr(10) || (doc_id % 4) || chr(10) || chr(10) || 'more:' || chr(10) || '{}' || chr(10) || chr(10) || chr(10) || chr(10) || 'Use what is given, trust the first description where parts disagree, name no source and no field.' || chr(10) || chr(10)
  || CASE WHEN lang = 'zh' THEN 'Write in Chinese; quote lyrics as they are.' ELSE 'Write in English; quote lyrics as they are.' END || chr(10) || 'Write one paragraph.' || chr(10) || 'Name chords by their degrees in the key.' || chr(10) || chr(10) || 'Answer with the description alone.' || chr(10)) AS m FROM documents""")
def fn15(spark, sf):
    none = F.lit(None).cast("string")
    even = F.col("doc_id") % 2 == 0
    prompt = lambda hide: M.caption_prompt(F.concat(F.lit("/m/"), "source"), F.col("n_chars") / 4, F.col("text"), F.when(F.col("doc_id") % 3 == 0, F.col("lang")), F.lit(""), F.col("doc_id") % 4, none, none, none, none, none, X.normalize_language(F.col("lang")), F.lit("paragraph"), F.lit("degree"), hide_path=hide)
    return _docs(spark, sf).select("doc_id", F.md5(F.when(even, prompt(False)).otherwise(prompt(True))).alias("m"))


@query("fn16_query_prompt", "SELECT doc_id, md5('Write one SHORT request in EN that a description in the form of x would answer. Seed ' || sha1(source)[:8] || '.' || chr(10) || 'Description: ' || coalesce(text, '') || chr(10) || 'Answer as JSON with the field prompt.' || chr(10)) AS p FROM documents")
def fn16(spark, sf):
    return _docs(spark, sf).select("doc_id", F.md5(M.filled(M.QUERY_TEMPLATE, length=F.lit("SHORT"), language=F.lit("EN"), style=F.lit("x"), seed=H.seed(F.col("source")), caption=F.col("text"))).alias("p"))


@query("fn17_blocks", """
SELECT doc_id, 'verse' AS label, 10.0::DOUBLE AS start, 20.5::DOUBLE AS "end", 'hi ' || lang AS text FROM documents UNION ALL SELECT doc_id, 'chorus', 20.5, 30.0, 'yo' || chr(10) || source FROM documents""")
def fn17(spark, sf):
    text = F.concat(F.lit("[verse] [00:00:10.000]\nhi "), F.col("lang"), F.lit("\n\n[chorus] [00:00:20.500]\nyo\n"), F.col("source"), F.lit("\n[00:00:30.000]\n"))
    return _docs(spark, sf).select("doc_id", F.explode(R.parse_blocks(text)).alias("x")).select("doc_id", "x.*")


@query("fn18_clock", "SELECT doc_id, (n_chars // 60 % 60) * 60.0 + n_chars % 60 + 3600.25 AS s FROM documents")
def fn18(spark, sf):
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    clock = F.concat(F.lit("01:"), two(F.floor(F.col("n_chars") / 60) % 60), F.lit(":"), two(F.col("n_chars") % 60), F.lit(".250"))
    return _docs(spark, sf).select("doc_id", X.clock_to_seconds(F.concat(F.translate("text", "0123456789", ""), F.lit(" ["), clock, F.lit("] 99:99"))).alias("s"))


@query("fn19_hms", "SELECT doc_id, lpad((n_chars // 3600)::VARCHAR, 2, '0') || ':' || lpad((n_chars // 60 % 60)::VARCHAR, 2, '0') || ':' || lpad((n_chars % 60)::VARCHAR, 2, '0') AS c FROM documents")
def fn19(spark, sf):
    return _docs(spark, sf).select("doc_id", X.seconds_to_clock(F.col("n_chars") + 0.25).alias("c"))


@query("fn20_formats", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'N/A' ELSE doc_id::VARCHAR || '.500' END AS t, CASE doc_id % 3 WHEN 0 THEN 'N/A' WHEN 1 THEN 'C' ELSE 'C minor' END AS k FROM documents")
def fn20(spark, sf):
    third = F.col("doc_id") % 3
    return _docs(spark, sf).select("doc_id", X.fixed3(F.when(third != 0, F.col("doc_id") + 0.5)).alias("t"), X.key_name(F.when(third != 0, "C"), F.when(third == 2, "minor").otherwise("")).alias("k"))


@query("fn21_urls", "SELECT page_id, regexp_matches(url, '(?i)^https?://') AS is_url, CASE WHEN page_id % 2 = 0 THEN url ELSE 'file:///a/' || page_id END AS media FROM pages")
def fn21(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.is_url(F.col("url")).alias("is_url"), X.media_url(F.when(F.col("page_id") % 2 == 0, F.col("url")).otherwise(F.concat(F.lit("/a/"), F.col("page_id").cast("string")))).alias("media"))


@query("fn22_host", "SELECT page_id, regexp_extract(url, '^[a-z]+://([^/]*)', 1) AS host FROM pages")
def fn22(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.host_of(F.col("url")).alias("host"))


@query("fn23_stem", "SELECT doc_id, source AS stem, '/m/' || lang AS parent, '.flac' AS suffix FROM documents")
def fn23(spark, sf):
    path = F.concat(F.lit("/m/"), F.col("lang"), F.lit("/"), F.col("source"), F.lit(".FLAC"))
    return _docs(spark, sf).select("doc_id", X.path_stem(path).alias("stem"), X.path_parent(path).alias("parent"), X.path_suffix(path).alias("suffix"))


@query("fn24_uid", "SELECT doc_id, lpad(doc_id::VARCHAR, 9, '0') AS uid FROM documents")
def fn24(spark, sf):
    return _docs(spark, sf).select("doc_id", X.line_uid(F.col("doc_id")).alias("uid"))


@query("fn30_length_class", """
SELECT doc_id, CASE WHEN s = 'sections' THEN CASE WHEN x < 15 THEN 'SHORT' WHEN x < 70 THEN 'MEDIUM' ELSE 'LONG' END ELSE CASE WHEN x < 60 THEN 'SHORT' WHEN x < 90 THEN 'MEDIUM' ELSE 'LONG' END END AS c
FROM (SELECT doc_id, s, ('0x' || md5(doc_id::VARCHAR || ':' || s)[:8])::UBIGINT % 100 AS x FROM (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'sections' ELSE 'paragraph' END AS s FROM documents))""")
def fn30(spark, sf):
    style = F.when(F.col("doc_id") % 2 == 0, "sections").otherwise("paragraph")
    return _docs(spark, sf).select("doc_id", H.length_class(F.col("doc_id").cast("string"), style).alias("c"))


@query("fn31_seed", "SELECT doc_id, sha1(doc_id::VARCHAR)[:8] AS seed FROM documents")
def fn31(spark, sf):
    return _docs(spark, sf).select("doc_id", H.seed(F.col("doc_id").cast("string")).alias("seed"))


@query("fn32_softmax", """
WITH e AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS "at", unnest(embedding)::DOUBLE AS x FROM embeddings), m AS (SELECT *, exp(x - max(x) OVER (PARTITION BY vec_id)) AS y FROM e)
SELECT vec_id, "at"::INTEGER AS "at", round(y / sum(y) OVER (PARTITION BY vec_id), 6) AS p, round(1 / (1 + exp(-x)), 6) AS s FROM m""")
def fn32(spark, sf):
    both = F.arrays_zip(A.softmax(F.col("embedding")).alias("p"), F.transform("embedding", lambda x: A.sigmoid(x.cast("double"))).alias("s"))
    return table(spark, sf, "embeddings").select("vec_id", F.posexplode(both).alias("at", "x")).select("vec_id", "at", F.round("x.p", 6).alias("p"), F.round("x.s", 6).alias("s"))


@query("fn33_masked", "SELECT vec_id, (list_position(embedding, list_max(list_filter(embedding, lambda x, i: i IN (1, 2, 3, 4, 5, 6, 7, 27)))) - 1)::BIGINT AS best FROM embeddings")
def fn33(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", A.argmax(A.masked(F.col("embedding"), schemas.ALLOWED_LABELS[5])).alias("best"))


@query("fn34_frame_times", "SELECT doc_id, round((doc_id % 10) * 7.5 / 16, 3) AS t FROM documents")
def fn34(spark, sf):
    return _docs(spark, sf).select("doc_id", A.frame_time(F.col("doc_id") % 10, F.lit(7.5), F.lit(16)).alias("t"))


@query("fn35_active", "SELECT vec_id, coalesce(string_agg(n, ',' ORDER BY n) FILTER (x >= 0.1), '') AS names FROM (SELECT vec_id, unnest(embedding[1:5])::DOUBLE AS x, unnest(['e', 'd', 'c', 'b', 'a']) AS n FROM embeddings) GROUP BY vec_id")
def fn35(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", F.array_join(A.active_names(F.transform(F.slice("embedding", 1, 5), lambda x: x.cast("double")), list("edcba"), 0.1), ",").alias("names"))


@query("fn36_millis", "SELECT event_id, trunc(round(value, 3) * 1000)::BIGINT AS ms FROM events")
def fn36(spark, sf):
    return events(spark, sf).select("event_id", A.millis(F.col("value")).alias("ms"))


@query("fn37_names", "SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter(list_transform(string_split(coalesce(text, ''), ' ')[1:30], lambda x: trim(x)), lambda x: x <> ''))), ',') AS names FROM documents")
def fn37(spark, sf):
    return _docs(spark, sf).select("doc_id", F.array_join(A.normalize_names(F.concat(F.slice(F.split(F.coalesce("text", F.lit("")), " "), 1, 30), F.array(F.lit(None).cast("string"), F.lit(" ")))), ",").alias("names"))


@query("fn40_weights", "SELECT doc_id, round(n_chars + doc_id % 3, 6)::DOUBLE AS total FROM documents")
def fn40(spark, sf):
    found = H.parse_weights(F.concat(F.lit('{"a": '), F.col("n_chars").cast("string"), F.lit(', "b": '), (F.col("doc_id") % 3).cast("string"), F.lit(', "x": 9, "c": -1}')), ["a", "b", "c"])
    return _docs(spark, sf).select("doc_id", F.round(F.aggregate(F.map_values(found), F.lit(0.0), lambda s, x: s + x), 6).alias("total"))


@query("fn41_chat", """
SELECT conv_id, turn, 'user:<audio>' || text || '|assistant:' || answer || '|' || conv_id AS chat FROM (SELECT *, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS answer, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS r2 FROM conversations) WHERE role = 'user' AND r2 = 'assistant'""")
def fn41(spark, sf):
    from pyspark.sql import Window as W

    w = W.partitionBy("conv_id").orderBy("turn")
    turns = table(spark, sf, "conversations").withColumns({"answer": F.lead("text").over(w), "r2": F.lead("role").over(w)}).filter("role = 'user' AND r2 = 'assistant'")
    chat = M.chat_record(F.col("text"), F.col("answer"), F.col("conv_id").cast("string"), F.struct("turn"))
    said = F.array_join(F.transform(F.col("c.messages"), lambda m: F.concat_ws(":", m["role"], m["content"])), "|")
    return turns.select("conv_id", "turn", chat.alias("c")).select("conv_id", "turn", F.concat_ws("|", said, F.element_at("c.audios", 1)).alias("chat"))


@query("fn42_codebook", """
WITH v AS (SELECT vec_id, embedding, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS n FROM embeddings), d AS (SELECT vec_id, k, list_sum(list_transform(embedding, lambda x, i: (x::DOUBLE / n - CASE WHEN i % 4 = k THEN 0.25 ELSE 0.0 END) ** 2)) AS far FROM v, range(4) t(k))
SELECT vec_id, arg_min(k, far)::BIGINT AS best FROM d GROUP BY vec_id""")
def fn42(spark, sf):
    book = [[0.25 if (i + 1) % 4 == k else 0.0 for i in range(64)] for k in range(4)]
    return table(spark, sf, "embeddings").select("vec_id", A.nearest(F.col("embedding"), book).alias("best"))


@query("fn39_pretty_json", """SELECT doc_id, '{' || chr(10) || '  "lang": "' || lang || '",' || chr(10) || '  "tags": [' || chr(10) || '    "é",' || chr(10) || '    ' || n_chars || chr(10) || '  ]' || chr(10) || '}' AS j FROM documents""")
def fn39(spark, sf):
    flat = F.concat(F.lit('{"lang":"'), "lang", F.lit('","tags":["é",'), F.col("n_chars").cast("string"), F.lit("]}"))
    return _docs(spark, sf).select("doc_id", X.pretty_json(flat).alias("j"))


_CENTRES = """
  c{i} AS (SELECT k, list(m ORDER BY pos) AS v FROM (SELECT k, pos, avg(x) AS m FROM (SELECT k, generate_subscripts(v, 1) AS pos, unnest(v) AS x FROM (SELECT arg_min(k, far) AS k, any_value(v) AS v FROM (SELECT vec_id, p.v, k, list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) ** 2)) AS far FROM p, c{j} c) GROUP BY vec_id)) GROUP BY k, pos) GROUP BY k
    UNION ALL SELECT k, v FROM c{j} WHERE k NOT IN (SELECT k FROM (SELECT arg_min(k, far) AS k FROM (SELECT vec_id, k, list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) ** 2)) AS far FROM p, c{j} c) GROUP BY vec_id)))"""


@query("fn43_kmeans", "WITH p AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings), c0 AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS k, v FROM (SELECT * FROM p ORDER BY vec_id LIMIT 4))," + ",".join(_CENTRES.format(i=i, j=i - 1) for i in (1, 2, 3)) + " SELECT vec_id, arg_min(k, far)::BIGINT AS cluster FROM (SELECT vec_id, k, list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) ** 2)) AS far FROM p, c3 c) GROUP BY vec_id")
def fn43(spark, sf):
    from cadenza.operators.clustering import kmeans

    return kmeans(table(spark, sf, "embeddings").select("vec_id", "embedding"), "vec_id", "embedding", 4, 3, metric="l2")


@query("fn43_kmeans_cosine")
def fn43_cosine(spark, sf):
    from cadenza.operators.clustering import kmeans

    return kmeans(table(spark, sf, "embeddings").select("vec_id", "embedding"), "vec_id", "embedding", 4, 5)


@query("st03_topk", """
SELECT vec_id, r, "at", value FROM (SELECT vec_id, "at", value, row_number() OVER (PARTITION BY vec_id ORDER BY value DESC, "at") - 1 AS r FROM (SELECT vec_id, (generate_subscripts(embedding, 1) - 1)::BIGINT AS "at", unnest(embedding) AS value FROM embeddings)) WHERE r < 5""")
def st03(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", F.posexplode(A.top_k(F.col("embedding"), 5)).alias("r", "x")).select("vec_id", F.col("r").cast("long").alias("r"), "x.*")


@query("st04_argmax", "SELECT vec_id, (list_position(embedding, list_max(embedding)) - 1)::BIGINT AS best FROM embeddings")
def st04(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", A.argmax(F.col("embedding")).alias("best"))


_HASH = "('0x' || md5(doc_id::VARCHAR || '{salt}')[:8])::UBIGINT"


@query("st13_weighted", f"SELECT doc_id, CASE WHEN u <= 1 THEN 'a' WHEN u <= 3 THEN 'b' ELSE 'c' END AS pick FROM (SELECT doc_id, ({_HASH.format(salt='m')} % 1048576) / 1048576.0 * 4 AS u FROM documents)")
def st13(spark, sf):
    return _docs(spark, sf).select("doc_id", H.weighted_choice(F.col("doc_id").cast("string"), {"a": 1, "b": 2, "x": -1, "c": 1}, "a", "m").alias("pick"))


@query("st14_pool", f"SELECT doc_id, ['x', 'y', 'z'][({_HASH.format(salt='')} % 3 + 1)::BIGINT] AS pick FROM documents")
def st14(spark, sf):
    return _docs(spark, sf).select("doc_id", H.pool_choice(F.col("doc_id").cast("string"), ["x", "y", "z"]).alias("pick"))


@query("ud11_stub_captions", "SELECT doc_id, lang, 'stub ' || md5(doc_id::VARCHAR)[:8] AS caption, NULL::VARCHAR AS error FROM documents")
def ud11(spark, sf):
    from cadenza.operators.backends import StubText, run_backend

    return run_backend(_docs(spark, sf).select("doc_id", "lang"), lambda: StubText("doc_id", "caption"), "caption STRING")
