"""Queries of sources, sinks, runs and model stages: tables go out through a sink or a stage and come back as rows that SQL can state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.config import Settings, override
from cadenza.functions import audio as U
from cadenza.functions import text as X
from cadenza.operators import analysis as Y
from cadenza.operators import backends as B
from cadenza.operators import reshape as R
from cadenza.operators import resume as Z
from cadenza.plans.registry import events, query, table
from cadenza.sources import jsonl, media, sinks
from cadenza.storage import Scratch


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")


def _lines(spark: SparkSession, sf: str) -> str:
    """A folder of JSON lines of the documents' short columns, with a line of another kind for every tenth."""
    where = Scratch(spark, "lines").dir("in")
    good = F.to_json(F.struct("doc_id", "lang", F.struct(F.col("source").alias("name")).alias("origin")))
    bad = F.concat(F.lit("[not an object "), F.col("doc_id").cast("string"))
    _docs(spark, sf).select(F.explode(F.when(F.col("doc_id") % 10 == 0, F.array(good, bad, F.lit("  "))).otherwise(F.array(good))).alias("value")).repartition(3).write.text(f"{where}/deep/er")
    return where


def _as_jsonl(spark: SparkSession, where: str) -> str:
    """The folder with its text files under names that end in .jsonl."""
    from cadenza.storage import file_system, names_in

    fs, folder = file_system(spark, f"{where}/deep/er")
    for name in names_in(spark, f"{where}/deep/er"):
        if name.startswith("part-"):
            _, old = file_system(spark, f"{where}/deep/er/{name}")
            _, new = file_system(spark, f"{where}/deep/er/{name.removesuffix('.txt')}.jsonl")
            fs.rename(old, new)
    return where


@query("src01_jsonl", "SELECT doc_id, lang, source AS name, NULL AS bad FROM documents UNION ALL SELECT NULL, NULL, NULL, '[not an object ' || doc_id FROM documents WHERE doc_id % 10 = 0")
def src01(spark, sf):
    good, bad = jsonl.read_jsonl(spark, _as_jsonl(spark, _lines(spark, sf)), "doc_id long, lang string, origin struct<name:string>")
    return good.select("doc_id", "lang", "origin.name").unionByName(bad.select(F.col("line").alias("bad")), allowMissingColumns=True)


@query("src02_jsonl_strict", "SELECT doc_id, lang FROM documents")
def src02(spark, sf):
    where = Scratch(spark, "strict").dir("in")
    sinks.write_jsonl(_docs(spark, sf).select("doc_id", "lang"), where)
    from cadenza.storage import file_system, names_in

    fs, _ = file_system(spark, where)
    for name in [n for n in names_in(spark, where) if n.endswith(".json")]:
        fs.rename(file_system(spark, f"{where}/{name}")[1], file_system(spark, f"{where}/{name}l")[1])
    return jsonl.read_jsonl_strict(spark, where, "doc_id long, lang string").select("doc_id", "lang")


@query("src03_discovery", "SELECT 3 AS files, 1 AS folders")
def src03(spark, sf):
    where = _as_jsonl(spark, _lines(spark, sf))
    found = jsonl.discover(spark, [where, f"{where}/deep", where])
    return found.agg(F.count(F.lit(1)).cast("int").alias("files"), F.count_distinct(X.path_parent(F.col("path"))).cast("int").alias("folders"))


@query("src08_reader_registry", "SELECT lang, count(*) AS n FROM documents GROUP BY lang")
def src08(spark, sf):
    media.register_reader("documents", lambda s, path: s.read.parquet(f"{path}/documents.parquet"), "docs")
    return media.open_reader(spark, "Docs", sf, columns=["lang"]).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


@query("src13_segment_files", "SELECT 'segment_a' AS name, 'segment_a.jsonl' AS file, '/out/segment_a.jsonl' AS output_path")
def src13(spark, sf):
    where = Scratch(spark, "segments").dir("in")
    sinks.write_by_source(_docs(spark, sf).select("doc_id", F.when(F.col("doc_id") % 2 == 0, "segment_a").otherwise("other").alias("s")), F.concat("s", F.lit(".jsonl")), where)
    found = spark.read.option("recursiveFileLookup", "true").json(f"{where}/segment_a.jsonl").select(F.lit(f"{where}/segment_a.jsonl").alias("path")).distinct()
    return found.select(X.path_stem(F.col("path")).alias("name"), X.file_name(F.col("path")).alias("file"), F.concat(F.lit("/out/"), X.file_name(F.col("path"))).alias("output_path"))


@query("jn13_without_output", "SELECT doc_id FROM documents WHERE doc_id % 2 = 0")
def jn13(spark, sf):
    where = Scratch(spark, "merge").dir("in")
    rows = _docs(spark, sf).select(F.to_json(F.struct("doc_id")).alias("value"), (F.col("doc_id") % 2).alias("odd"))
    for odd, name in ((0, "in"), (1, "out")):
        rows.filter(F.col("odd") == odd).select("value").coalesce(1).write.text(f"{where}/{name}")
    from cadenza.storage import file_system, names_in

    for name in ("in", "out"):
        part = next(n for n in names_in(spark, f"{where}/{name}") if n.startswith("part-"))
        fs, old = file_system(spark, f"{where}/{name}/{part}")
        fs.rename(old, file_system(spark, f"{where}/{name}/{name}.jsonl")[1])
    return jsonl.read_lines(spark, where, without="/out.jsonl").select(F.from_json("line", "doc_id long")["doc_id"].alias("doc_id"))


@query("snk01_jsonl", "SELECT doc_id, text FROM documents")
def snk01(spark, sf):
    where = Scratch(spark, "jsonl").dir("out")
    docs = _docs(spark, sf).select("doc_id", "text")
    sinks.write_jsonl(docs.filter("doc_id % 2 = 0"), where)
    sinks.write_jsonl(docs.filter("doc_id % 2 = 1"), where)
    return spark.read.schema(docs.schema).json(where)


@query("snk02_snapshots", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'ok' ELSE 'new' END AS state FROM documents")
def snk02(spark, sf):
    where = Scratch(spark, "snapshots").dir("out")
    docs = _docs(spark, sf).select("doc_id")
    sinks.run_in_lots(docs.filter("doc_id % 3 <> 1"), lambda part: part.select("doc_id", F.when(F.col("doc_id") % 3 == 0, "ok").otherwise("failed").alias("state"), F.lit(1).alias("ord")), where, ["doc_id"], ["ord"], 3)
    sinks.snapshot(docs.filter("doc_id % 3 <> 0").select("doc_id", F.lit("new").alias("state"), F.lit(2).alias("ord")), where, ["doc_id"], ["ord"])
    return spark.read.parquet(where).drop("ord")


@query("snk04_rejects", "SELECT doc_id, doc_id % 4 = 0 AS rejected FROM documents")
def snk04(spark, sf):
    where = Scratch(spark, "rejects")
    sinks.split_write(_docs(spark, sf).select("doc_id", F.when(F.col("doc_id") % 4 == 0, "bad").when(F.col("doc_id") % 4 == 1, "").alias("error")), F.col("error"), where.dir("good"), where.dir("bad"))
    read = lambda name, flag: spark.read.schema("doc_id long, error string").json(where.dir(name)).select("doc_id", F.lit(flag).alias("rejected"))
    return read("good", False).unionByName(read("bad", True))


@query("snk06_named_outputs", "SELECT doc_id, source || '.jsonl' AS file FROM documents")
def snk06(spark, sf):
    where = Scratch(spark, "named").dir("out")
    sinks.write_by_source(_docs(spark, sf).select("doc_id", "source"), F.concat(F.lit("/in/"), "source", F.lit(".jsonl")), where)
    return spark.read.option("recursiveFileLookup", "true").schema("doc_id long").json(where).select("doc_id", X.file_name(X.path_parent(F.col("_metadata.file_path"))).alias("file"))


@query("snk07_step_and_marker", "SELECT lang, count(*) AS n, true AS done, 1 AS runs FROM documents GROUP BY lang")
def snk07(spark, sf):
    where, runs = Scratch(spark, "step").dir("out"), []

    def make() -> DataFrame:
        runs.append(1)
        return _docs(spark, sf).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))

    sinks.step(spark, where, make)
    return sinks.step(spark, where, make).select("lang", "n", F.lit(sinks.is_done(spark, where)).alias("done"), F.lit(len(runs)).alias("runs"))


@query("snk08_cut_plan", """
SELECT doc_id, label_idx, least(100.0, 10.0 * label_idx + 0.5) AS clip_end FROM (SELECT doc_id, unnest(range(1, 4)) AS label_idx FROM documents) WHERE label_idx <> 2""")
def snk08(spark, sf):
    seg = F.array(*[F.struct(F.lit(n).alias("label"), F.lit(a).alias("start"), F.lit(a + 10.0).alias("end"), F.lit(i).cast("long").alias("label_idx")) for i, (n, a) in enumerate((("verse", 0.0), ("Silence", 10.0), ("chorus", 20.0)), 1)])
    rows = R.segments_of(_docs(spark, sf).select("doc_id", F.lit(100.0).alias("duration"), seg.alias("segments")), "segments", ["doc_id", "duration"])
    return R.cut_plan(rows, 0.5).select("doc_id", "label_idx", "clip_end")


_FLAT = "SELECT doc_id, lang AS chord, source AS key, n_chars AS bpm, NULL::VARCHAR AS extra, 'audio_path,song_structure_info,doc_id,chords,beatnet,music_key,instruments_changes' AS columns FROM documents"


@query("prj01_flatten", _FLAT)
def prj01(spark, sf):
    cpu = F.struct(F.struct(F.col("lang").alias("chord")).alias("chords"), F.struct(F.col("n_chars").alias("bpm")).alias("beatnet"), F.struct(F.col("source").alias("key")).alias("key"))
    rows = _docs(spark, sf).select("doc_id", cpu.alias("music_cpu"), F.struct(F.lit(1).alias("changes")).alias("music_gpu"), F.lit("x").alias("_alm_prompt"), F.lit("y").alias("_mine"), F.lit("z").alias("key_change"), F.lit("p").alias("audio_path"), F.lit("s").alias("song_structure_info"))
    out = R.flatten_analysis(rows)
    return out.select("doc_id", "chords.chord", "music_key.key", "beatnet.bpm", F.lit(None).cast("string").alias("extra"), F.lit(",".join(out.columns)).alias("columns"))


@query("prj04_old_format", "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN lang || '|' || source ELSE '|' END AS texts FROM documents")
def prj04(spark, sf):
    spans = F.array(*[F.struct(F.lit(a).alias("start"), F.lit(b).alias("end")) for a, b in ((0.0, 10.0), (10.0, 20.0))])
    said = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("[verse] [00:00:00.000]\n"), "lang", F.lit("\n[chorus] [00:00:10.000]\n"), "source", F.lit("\n[00:00:20.000]")))
    return _docs(spark, sf).select("doc_id", F.array_join(F.transform(R.segments_of_old_format(spans, said), lambda s: s["asr_text"]), "|").alias("texts"))


@query("prj07_descriptive", """SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '{"title":"' || source || '","genres":["' || lang || '"]}' ELSE '{"title":"' || source || '","genres":["old"]}' END AS j FROM documents""")
def prj07(spark, sf):
    resolved = F.struct(F.when(F.col("doc_id") % 2 == 0, F.array("lang")).otherwise(F.array().cast("array<string>")).alias("genres"), F.array().cast("array<string>").alias("moods"))
    rows = _docs(spark, sf).select("doc_id", F.col("source").alias("title"), F.array(F.lit("old")).alias("genres"), resolved.alias("resolved_music_metadata"), F.lit("no").alias("other"))
    return rows.select("doc_id", R.descriptive_json(rows).alias("j"))


@query("prj02_mirrored_dirs", "SELECT page_id, CASE WHEN page_id % 2 = 0 THEN '/o/' || (page_id % 7) || '/x' ELSE '/o' END AS d FROM pages")
def prj02(spark, sf):
    path = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("/r/"), (F.col("page_id") % 7).cast("string"), F.lit("/x/a.mp3"))).otherwise(F.lit("/elsewhere/a.mp3"))
    return table(spark, sf, "pages").select("page_id", R.mirrored_dir(path, "/r/", "/o").alias("d"))


@query("fn45_settings", "SELECT 64 AS batch, true AS keep_silence, 0.5::DOUBLE AS pad, 3 AS attempts")
def fn45(spark, sf):
    s = override(Settings(), ["batch=64", "keep_silence=yes", "pad=0.5"])
    return spark.createDataFrame([(s.batch, s.keep_silence, s.pad, s.attempts)], "batch int, keep_silence boolean, pad double, attempts int")


@query("fn46_checksums", "SELECT 'part-0000' || i AS name, i % 2 = 0 AS ok FROM range(5) t(i) UNION ALL SELECT 'missing', false")
def fn46(spark, sf):
    where = Scratch(spark, "sums").dir("in")
    spark.range(0, 5, 1, 5).select(F.concat(F.lit("file "), F.col("id").cast("string")).alias("value")).write.text(where)
    name = F.substring("name", 1, 10)
    files = spark.read.format("binaryFile").load(where).select(X.file_name(F.col("path")).alias("name"), F.md5("content").alias("md5"))
    expected = files.select("name", F.when(F.substring(name, 10, 1).cast("int") % 2 == 0, F.col("md5")).otherwise("0").alias("md5"))
    gone = spark.createDataFrame([("missing", "0")], "name string, md5 string")
    return media.verify_checksums(spark, where, expected.unionByName(gone)).select(name.alias("name"), "ok")


@query("rs03_by_count", "SELECT doc_id FROM documents ORDER BY doc_id OFFSET 37")
def rs03(spark, sf):
    return Z.by_count(_docs(spark, sf).select("doc_id"), "doc_id", 37)


@query("rs04_resume_merge", "SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN lang WHEN doc_id % 4 = 1 THEN NULL WHEN doc_id % 3 = 0 THEN source END AS found FROM documents")
def rs04(spark, sf):
    docs = _docs(spark, sf)
    stored = docs.filter("doc_id % 4 < 2").select("doc_id", F.when(F.col("doc_id") % 4 == 0, F.col("lang")).alias("found"))
    return Z.resume_merge(docs.select("doc_id"), stored, docs.filter("doc_id % 3 = 0").select("doc_id", F.col("source").alias("found")), "doc_id", "found")


@query("rs07_allocation", "SELECT id, (id - 150 + 200) % 200 AS ahead FROM range(200) t(id) WHERE id NOT IN (SELECT user_id FROM events WHERE event_type = 'error') ORDER BY ahead LIMIT 60")
def rs07(spark, sf):
    return Z.allocate(spark, 200, events(spark, sf).filter("label = 'error'").select(F.col("song").alias("id")), "id", 150, 60)


@query("rs10_retries", "SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE doc_id * 2 END AS twice, CASE WHEN doc_id % 5 = 0 THEN 'ValueError: no audio' END AS error FROM documents")
def rs10(spark, sf):
    class Twice:
        def load(self) -> None:
            self.calls = 0

        def generate(self, batch):
            self.calls += 1
            if self.calls % 3 == 1:
                raise OSError("busy")
            if any(r["doc_id"] % 5 == 0 for r in batch):
                raise ValueError("no audio")
            return [{"twice": r["doc_id"] * 2} for r in batch]

    return B.run_backend(_docs(spark, sf).select("doc_id"), Twice, "twice LONG", batch=16, attempts=3, first=0.0)


@query("fn44_mono", "SELECT vec_id, (i - 1)::INTEGER AS at, round((embedding[i]::DOUBLE + embedding[65 - i]::DOUBLE) / 2, 6) AS x FROM (SELECT vec_id, embedding, unnest(range(1, 65)) AS i FROM embeddings)".replace(" AS at", ' AS "at"'))
def fn44(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", F.posexplode(U.mono(F.array("embedding", F.reverse("embedding")))).alias("at", "x")).select("vec_id", "at", F.round("x", 6).alias("x"))


@query("fn44_padding", "SELECT doc_id, n_chars % 7 AS own, (7 - 1) - n_chars % 7 AS filled FROM documents WHERE (SELECT max(n_chars % 7) FROM documents) = 6")
def fn44_padding(spark, sf):
    rows = _docs(spark, sf).select("doc_id", F.lit(1).alias("batch"), F.array_repeat(F.lit(1.0), (F.col("n_chars") % 7).cast("int")).alias("v"))
    out = U.padded_batches(rows, ["batch"], "v")
    return out.select("doc_id", F.aggregate("padded.values", F.lit(0.0), lambda s, x: s + x).cast("long").alias("own"), F.size(F.filter("padded.is_padding", lambda p: p)).cast("long").alias("filled"))


@query("ud17_losses", """
WITH v AS (SELECT vec_id, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS x, label FROM embeddings), d AS (SELECT *, lead(x) OVER (PARTITION BY vec_id ORDER BY i) AS y, exp(x) / sum(exp(x)) OVER (PARTITION BY vec_id) AS p FROM v)
SELECT vec_id, round(0.4 * avg(abs(y - x) + 1e-8), 6) AS tv, round(max(CASE WHEN i = label % 64 + 1 THEN 0.25 * (1 - p) ** 2 * -ln(p) END), 6) AS focal FROM d GROUP BY vec_id""")
def ud17(spark, sf):
    rows = table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v"), (F.col("label") % 64).alias("label"))
    return rows.select("vec_id", F.round(U.variation_loss(F.col("v")), 6).alias("tv"), F.round(U.focal_loss(F.col("v"), F.col("label")), 6).alias("focal"))


def _paths(spark, sf):
    return _docs(spark, sf).select("doc_id", F.col("doc_id").cast("string").alias("audio_path"))


_H = "('0x' || md5(doc_id::VARCHAR)[:16])::UBIGINT"


@query("ud01_chords", f"SELECT doc_id, CASE WHEN h % 3 = 0 THEN 'C' ELSE 'C G' END AS progression, CASE WHEN h % 3 = 0 THEN 1 ELSE 2 END AS n FROM (SELECT doc_id, {_H} AS h FROM documents)")
def ud01(spark, sf):
    make = lambda h: {"raw_chords": [{"chord": c, "timestamp": float(i)} for i, c in enumerate(["C", "N" if h % 3 == 0 else "G", "N"])]}
    out = Y.run_stage(_paths(spark, sf), Y.CHORDS, lambda: B.StubRaw("audio_path", make))
    return out.select("doc_id", F.array_join("chords.progression", " ").alias("progression"), F.size("chords.values").alias("n"))


@query("ud02_beats", f"SELECT doc_id, 4 AS top, round(60.0 / (0.5 + (h % 10) / 10.0), 6) AS bpm FROM (SELECT doc_id, {_H} AS h FROM documents)")
def ud02(spark, sf):
    make = lambda h: {"raw_beats": [{"timestamp": i * (0.5 + h % 10 / 10), "beat": i % 4 + 1} for i in range(9)]}
    out = Y.run_stage(_paths(spark, sf), Y.BEATS, lambda: B.StubRaw("audio_path", make))
    return out.select("doc_id", F.col("beatnet.max_beat_number").cast("int").alias("top"), F.round("beatnet.bpm", 6).alias("bpm"))


@query("ud03_melody", f"SELECT doc_id, round(CASE h % 4 WHEN 0 THEN 0 ELSE 100.0 * (h % 4 + 1) / 2 END, 6)::DOUBLE AS mean, (CASE h % 4 WHEN 0 THEN 0 ELSE 100.0 * (h % 4 + 1) / 2 END)::DOUBLE AS median, (h % 4)::BIGINT AS voiced, 'C' AS key FROM (SELECT doc_id, {_H} AS h FROM documents)")
def ud03(spark, sf):
    make = lambda h: {"raw_pitch": [0.0, *(100.0 * (i + 1) for i in range(h % 4)), -1.0], "raw_key": {"key": "C", "scale": "major", "strength": 0.5}}
    out = Y.run_stage(_paths(spark, sf), Y.MELODY, lambda: B.StubRaw("audio_path", make))
    return out.select("doc_id", F.round("essentia.melody.pitch_mean_hz", 6).alias("mean"), F.col("essentia.melody.pitch_median_hz").alias("median"), F.col("essentia.melody.num_voiced_frames").alias("voiced"), "essentia.key.key")


@query("ud04_instruments", f"SELECT doc_id, CASE WHEN h % 2 = 0 THEN '1.0 piano;3.0 ' ELSE '0.0 drums,piano;1.0 piano;3.0 ' END AS changes FROM (SELECT doc_id, {_H} AS h FROM documents)")
def ud04(spark, sf):
    make = lambda h: {"raw_scores": [[0.0, 0.0] if h % 2 == 0 else [0.9, 0.9], [0.1, 0.0], [0.2, 0.0], [0.0, 0.0]], "raw_duration": 4.0}
    out = Y.run_stage(_paths(spark, sf), Y.instruments(["piano", "drums"], 0.1), lambda: B.StubRaw("audio_path", make))
    said = F.transform("music_gpu.changes", lambda c: F.concat(c["time"].cast("string"), F.lit(" "), F.array_join(c["active"], ",")))
    return out.select("doc_id", F.array_join(said, ";").alias("changes"))


@query("ud05_tags", f"SELECT doc_id, CASE h % 3 WHEN 0 THEN 'a b' WHEN 1 THEN 'b c' ELSE 'c a' END AS tags FROM (SELECT doc_id, {_H} AS h FROM documents)")
def ud05(spark, sf):
    make = lambda h: {"raw_probabilities": [[0.6, 0.3, 0.1], [0.1, 0.6, 0.3], [0.3, 0.1, 0.6]][h % 3]}
    out = Y.run_stage(_paths(spark, sf), Y.tags(["a", "b", "c"], 2), lambda: B.StubRaw("audio_path", make))
    return out.select("doc_id", F.array_join(F.transform("predictions", lambda p: p["label"]), " ").alias("tags"))


@query("ud06_detections", f"SELECT doc_id, CASE WHEN h % 2 = 0 THEN '0.5-1.5' ELSE '0.0-0.5,1.0-2.0' END AS spans FROM (SELECT doc_id, {_H} AS h FROM documents)")
def ud06(spark, sf):
    make = lambda h: {"raw_queries": [{"query": "voice", "hop": 0.5, "scores": [0.0, 0.9, 0.5, 0.1] if h % 2 == 0 else [0.9, 0.0, 0.5, 0.7]}]}
    out = Y.run_stage(_paths(spark, sf), Y.detections(0.5), lambda: B.StubRaw("audio_path", make))
    return out.select("doc_id", F.array_join(F.transform(F.element_at("dasm", 1)["spans"], lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["end"].cast("string"))), ",").alias("spans"))


@query("ud07_full_pipeline", "SELECT doc_id, CASE WHEN doc_id % 5 <> 0 THEN 1 END AS chords, 120.0::DOUBLE AS bpm, CASE WHEN doc_id % 5 = 0 THEN 'ValueError: no audio' END AS chords_error FROM documents")
def ud07(spark, sf):
    rows = _paths(spark, sf)
    fail = tuple(str(r["doc_id"]) for r in rows.filter("doc_id % 5 = 0").collect())
    chords = lambda: B.StubRaw("audio_path", lambda h: {"raw_chords": [{"chord": "C", "timestamp": 0.0}]}, fail)
    beats = lambda: B.StubRaw("audio_path", lambda h: {"raw_beats": [{"timestamp": 0.5 * i, "beat": 1} for i in range(4)]})
    melody = lambda: B.StubRaw("audio_path", lambda h: {"raw_pitch": [], "raw_key": None})
    out = Y.full_pipeline(rows, chords, beats, melody, attempts=1)
    return out.select("doc_id", F.when(F.col("music_cpu.chords").isNotNull(), F.size("music_cpu.chords.values")).alias("chords"), "music_cpu.beatnet.bpm", "music_cpu.chords_error")


@query("ud08_lite_pipeline", "SELECT doc_id, 'C' AS progression, 'A' AS key, 'chords,key,chords_error,essentia_error' AS fields FROM documents")
def ud08(spark, sf):
    chords = lambda: B.StubRaw("audio_path", lambda h: {"raw_chords": [{"chord": "C", "timestamp": 0.0}]})
    melody = lambda: B.StubRaw("audio_path", lambda h: {"raw_pitch": [], "raw_key": {"key": "A", "scale": "minor", "strength": 1.0}})
    out = Y.lite_pipeline(_paths(spark, sf), chords, melody)
    return out.select("doc_id", F.array_join("music_cpu.chords.progression", " ").alias("progression"), "music_cpu.key.key", F.lit(",".join(out.schema["music_cpu"].dataType.names)).alias("fields"))


@query("ud09_transcripts", "SELECT doc_id, 'stub ' || md5(doc_id::VARCHAR)[:8] AS text FROM documents")
def ud09(spark, sf):
    return Y.run_stage(_paths(spark, sf), Y.TRANSCRIPT, lambda: B.StubText("audio_path", "raw_text")).select("doc_id", "transcript.text")


@query("ud10_structure", f"SELECT doc_id, CASE WHEN h % 2 = 0 THEN 'intro 0.0-1.0|verse 1.0-3.0' ELSE 'intro 0.0-1.5|verse 1.5-3.0' END AS parts FROM (SELECT doc_id, {_H} AS h FROM documents)")
def ud10(spark, sf):
    def make(h: int) -> dict:
        cut = 2 if h % 2 == 0 else 3
        return {"raw_boundary": [3.0 if i == cut else -3.0 - i / 10 for i in range(6)], "raw_functions": [[2.0, 0.0] if i < cut else [0.0, 2.0] for i in range(6)]}

    out = Y.run_stage(_paths(spark, sf), Y.Stage("parts", Y.structure([], 1, 1, 1).fields, Y.structure_of(["intro", "verse"], 2.0, 4, 4, 0.5)), lambda: B.StubRaw("audio_path", make))
    return out.select("doc_id", F.array_join(F.transform("parts", lambda s: F.concat(s["label"], F.lit(" "), s["start"].cast("string"), F.lit("-"), s["end"].cast("string"))), "|").alias("parts"))
