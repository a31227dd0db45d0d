"""The steps of the annotation pipeline, end to end with stand-in models."""

import pytest
from pyspark.sql import functions as F

from cadenza.config import Settings, override
from cadenza.operators import reshape as R
from cadenza.operators import resume as Z
from cadenza.operators.backends import StubDuration, StubText, server_of
from cadenza.operators.quality import Limits
from cadenza.plans import annotation as P
from cadenza.sources import jsonl, media

MODELS = P.Models(StubDuration, lambda: StubText("audio_path", "base_caption"), lambda: StubText("clip", "text"), lambda: StubText("audio_path", "caption"), lambda: StubText("audio_path", "answer"))


def test_steps(spark):
    files = spark.createDataFrame([("/m/a.mp3",), ("/m/b.FLAC",), ("/m/.c.mp3",), ("/m/d.txt",)], "path string")
    data, failed = P.scan(files, MODELS, Settings())
    assert sorted(r["audio_path"] for r in data.collect()) == ["/m/a.mp3", "/m/b.FLAC"] and failed.count() == 0
    segments = F.array(*[F.struct(F.lit(n).alias("label"), F.lit(s).alias("start"), F.lit(e).alias("end")) for n, s, e in (("verse", 0.0, 0.4), ("silence", 0.4, 0.5), ("verse", 0.5, 0.55), ("chorus", 0.6, 0.9))])
    clips = P.cut(data.withColumn("segments", segments), Settings()).cache()
    assert clips.count() == 4
    keys = clips.select("clip", F.struct(F.lit("C").alias("key"), F.lit("major").alias("scale")).alias("key"), F.lit(0).alias("ord"))
    texts = clips.filter("label = 'verse'").select("clip", F.lit(" la la la la la la la la ").alias("text"), F.lit(0).alias("ord"))
    songs = P.songs_of_clips(clips, keys, texts)
    good, bad = P.clean(songs, Limits(never=10, least=10))
    assert bad.count() == 2 and {tuple(r["reasons"]) for r in bad.collect()} == {("speed", "repeated_chunk")}
    first = good.orderBy("audio_path").first()["song_structure_info"]
    assert [(s["segment"], s["asr_text"]) for s in first] == [("verse1", "la la la "), ("chorus1", "")]
    said = P.captions(good.withColumn("base_caption", F.lit("a song")), MODELS, Settings())
    assert said.filter("error IS NULL").count() == 2 and "verse1" in said.first()["llm_merge_prompt"]
    chat = P.chats(said, "f.jsonl", MODELS, Settings(), ["Describe it."]).collect()
    assert len(chat) == 2 and all(c["messages"][0]["content"] == "<audio>Describe it." and c["meta"]["source_file"] == "f.jsonl" for c in chat)


def test_settings():
    s = override(Settings(), ["batch=7", "keep_silence=yes", "pad = 0.5".replace(" ", "")])
    assert (s.batch, s.keep_silence, s.pad) == (7, True, 0.5)
    with pytest.raises(ValueError):
        override(s, ["nothing=1"])
    with pytest.raises(ValueError):
        override(s, ["keep_silence=perhaps"])


def test_small_helpers(spark, tmp_path):
    (tmp_path / "segment_1.jsonl").write_text('{"a": 1}\n')
    (tmp_path / "out.jsonl").write_text('{"a": 2}\n')
    assert [r["name"] for r in media.segment_files(spark, str(tmp_path), "/o").collect()] == ["segment_1"]
    assert jsonl.read_lines(spark, str(tmp_path), without="/out.jsonl").count() == 1
    sums = media.verify_checksums(spark, str(tmp_path), spark.createDataFrame([("out.jsonl", "x"), ("gone", "y")], "name string, md5 string"))
    assert [r["ok"] for r in sums.collect()] == [False, False]
    df = spark.createDataFrame([("t", ["a"], (["b"], []))], "title string, genres array<string>, resolved_music_metadata struct<genres:array<string>,moods:array<string>>")
    assert df.select(R.descriptive_json(df).alias("x")).first()["x"] == '{"title":"t","genres":["b"]}'
    paths = spark.createDataFrame([("/r/x/a.mp3",), ("/r/a.mp3",), ("/q/a.mp3",)], "p string")
    assert [r["d"] for r in paths.select(R.mirrored_dir(F.col("p"), "/r", "/o").alias("d")).collect()] == ["/o/x", "/o", "/o"]
    assert Z.watched(spark.createDataFrame([("",)], "error string"), "run", "error").count() == 1
    assert server_of(3, ["a", "b"]) == "b"
