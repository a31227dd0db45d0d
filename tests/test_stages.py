"""Media tools, chat models over HTTP, runs and progress, against stand-ins on this machine."""

import json
import stat
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.config import Settings
from cadenza.functions import audio as U
from cadenza.operators import media_tools as T
from cadenza.operators import monitor, resume
from cadenza.operators.backends import run_backend
from cadenza.operators.http_backend import ChatModel, audio_messages, content_text, prompt_messages
from cadenza.plans import annotation as P
from cadenza.sources import media, sinks
from cadenza.storage import exists

from .test_annotation import MODELS


@pytest.fixture
def tool(tmp_path):
    """A stand-in for the media tools: writes its arguments to its last one, or prints what it is to print; fails for names with ``bad``."""
    path = tmp_path / "tool.py"
    path.write_text("""#!/usr/bin/env python3
import struct, sys
args = sys.argv[1:]
if any("bad" in a for a in args):
    sys.exit("cannot read it")
if args[-1] == "pipe:":
    sys.stdout.buffer.write(struct.pack("<3f", 0.5, -0.5, 1.0))
elif "-show_entries" in args:
    print("nan" if "nan" in args[-1] else "12.5")
elif "empty" in args[-1]:
    open(args[-1], "w").close()
else:
    open(args[-1], "w").write(" ".join(args[:-1]))
""")
    path.chmod(path.stat().st_mode | stat.S_IEXEC)
    return str(path)


def test_media_tools(spark, tmp_path, tool):
    paths = spark.createDataFrame([("/a/x.mp3",), ("/a/bad.mp3",), ("/a/nan.mp3",)], "audio_path string")
    got = {r["audio_path"]: (r["duration"], r["error"]) for r in run_backend(paths, lambda: T.Probe(tool=tool), "duration DOUBLE", attempts=1).collect()}
    assert got["/a/x.mp3"] == (12.5, None) and "cannot read it" in got["/a/bad.mp3"][1] and "duration_fail" in got["/a/nan.mp3"][1]

    (tmp_path / "old.mp3").write_text("kept")
    videos = spark.createDataFrame([(f"{tmp_path}/old.mkv",), (f"{tmp_path}/new.mp4",), (f"{tmp_path}/empty.mp4",)], "video_path string")
    got = {r["video_path"].rsplit("/", 1)[1]: r for r in run_backend(videos, lambda: T.Transcode(tool=tool), "mp3_path STRING, status STRING", attempts=1).collect()}
    assert got["old.mkv"]["status"] == "reused" and got["new.mp4"]["status"] == "converted" and "nothing was written" in got["empty.mp4"]["error"]
    assert "libmp3lame -b:a 192k" in (tmp_path / "new.mp3").read_text() and not list(tmp_path.glob("*.part*")) and not (tmp_path / "empty.mp3").exists()

    clips = spark.createDataFrame([("/a/x.mp3", "c.flac", 1.0, 2.5)], "audio_path string, clip string, clip_start double, clip_end double")
    for accurate, said in ((True, "-i /a/x.mp3 -ss 1.000000 -to 2.500000 -ac 1 -ar 16000 -c:a flac"), (False, "-ss 1.000000 -t 1.500000 -i /a/x.mp3 -ac 1 -ar 16000 -c:a flac")):
        row = run_backend(clips, lambda: T.CutClip(f"{tmp_path}/clips", accurate, True, 16000, tool), "clip_path STRING").first()
        assert said in open(row["clip_path"]).read()
    parts = spark.createDataFrame([("b", "k", None, 0.0, 1.0), (None, None, "/a/bad", 0.0, 1.0)], "bucket string, object_key string, audio_path string, start double, end double")
    rows = run_backend(parts, lambda: T.Decode(lambda b, k: f"http://{b}/{k}", tool=tool), "samples ARRAY<FLOAT>", attempts=1).collect()
    assert [r["samples"] for r in rows] == [[0.5, -0.5, 1.0], None] and rows[1]["error"]


@pytest.fixture
def server():
    seen = {"asked": [], "fail": 0, "now": 0, "most": 0}
    lock = threading.Lock()

    class Answers(BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            with lock:
                seen["now"] += 1
                seen["most"] = max(seen["most"], seen["now"])
                seen["asked"].append((self.headers.get("Authorization"), body))
                fail = seen["fail"] > 0
                seen["fail"] -= fail
            text = json.dumps({"choices": [{"message": {"content": [{"type": "text", "text": " <|en|> la la "}]}}]}).encode()
            with lock:
                seen["now"] -= 1
            bad = fail or "refuse" in json.dumps(body["messages"])
            self.send_response(503 if bad else 200)
            self.end_headers()
            self.wfile.write(b"busy" if bad else text)

        def log_message(self, *args):
            pass

    at = HTTPServer(("127.0.0.1", 0), Answers)
    threading.Thread(target=at.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{at.server_port}", seen
    at.shutdown()


def test_chat_model(spark, server):
    url, seen = server
    seen["fail"] = 1
    clips = spark.createDataFrame([(f"/a/{i}",) for i in range(6)] + [("/a/refuse",), (" ",)], "audio_path string").coalesce(1)
    make = lambda: ChatModel([url, url + "/"], "m", audio_messages(["Write it down."]), "text", in_flight=3, attempts=2, first=0.0, token=lambda: "t0ken")
    rows = run_backend(clips, make, "text STRING", attempts=1).collect()
    assert sum(r["text"] == "<|en|> la la" for r in rows) == 6
    errors = {r["audio_path"]: r["error"] for r in rows if r["error"]}
    assert "HTTP 503: busy" in errors["/a/refuse"] and "missing_audio_path" in errors[" "]
    key, body = seen["asked"][0]
    assert key == "Bearer t0ken" and body["model"] == "m" and body["messages"][0]["content"][0]["audio_url"]["url"].startswith("file:///a/")
    assert seen["most"] <= 3
    assert content_text(" x ") == "x" and content_text([{"type": "image"}]) == '[{"type": "image"}]'
    assert prompt_messages("s", "p")({"p": "q"}) == [{"role": "system", "content": "s"}, {"role": "user", "content": "q"}]


def test_transcripts_are_asked_once(spark, server):
    url, seen = server
    models = P.Models(*[lambda: ChatModel([url], "m", audio_messages(["x"], "clip"), "text", first=0.0)] * 5)
    clips = spark.createDataFrame([("a",), ("b",), ("c",)], "clip string")
    before = spark.createDataFrame([("a", "known", None), ("b", "", "failed")], "clip string, text string, error string")
    got = {r["clip"]: r["text"] for r in P.transcribe(clips, models, Settings(), before, tag=True).collect()}
    assert got == {"a": "known", "b": "la la", "c": "la la"}
    assert P.first_captions(spark.createDataFrame([("/a",)], "audio_path string"), MODELS, Settings()).first()["base_caption"].startswith("stub")


def test_captions_use_the_analysis(spark):
    from cadenza import schemas

    schema = schemas.SONG + f", base_caption STRING, duration DOUBLE, chords {schemas.CHORDS}, beatnet {schemas.BEATS}, music_key {schemas.KEY}, instruments_changes {schemas.CHANGES}, lyrics STRING, title STRING"
    row = ("/m/a.mp3", [("verse1", "verse", 1, 0.0, 4.0, ("C", "major", 1.0), "c", "la")], "a song", 4.0, ([("C", 0.0), ("G", 2.0)], ["C", "G"]), ([(0.0, 1)], 4, 120.0), ("C", "major", 1.0), [(1.0, ["drums", "piano"]), (3.0, [])], "own words", "Title")
    songs = spark.createDataFrame([row], schema)
    prompt = P.captions(songs, MODELS, Settings()).first()["llm_merge_prompt"]
    for part in ("4.000000", "[verse1] [0.000] [C major]", "C G", "beats in a bar:\n4", "tempo in BPM:\n120.0", "key:\nC major", "[1.000 - 3.000] drums, piano", "lyrics:\nown words", '{\n  "title": "Title"\n}', "The lyrics given are the song's own.", "/m/a.mp3"):
        assert part in prompt, part
    assert "/m/a.mp3" not in P.captions(songs, MODELS, Settings(hide_path=True)).first()["llm_merge_prompt"]
    assert P.captions(songs, MODELS, Settings()).first()["caption_harmony_mode"] in ("basic", "degree")


def test_resampling():
    t = np.arange(8000) / 8000
    wave = np.sin(2 * np.pi * 440 * t)
    up = U.resampled(wave, 8000, 16000)
    assert len(up) == 16000 and np.abs(up[200:-200] - np.sin(2 * np.pi * 440 * np.arange(16000) / 16000)[200:-200]).max() < 0.01
    down = U.resampled(wave, 8000, 6000)
    assert len(down) == 6000 and np.abs(down[200:-200] - np.sin(2 * np.pi * 440 * np.arange(6000) / 6000)[200:-200]).max() < 0.01
    assert U.resampled(wave, 8000, 8000).tolist() == wave.tolist() and len(U.resampled(np.zeros(0), 8000, 6000)) == 0


def test_audio_columns(spark):
    df = spark.createDataFrame([([0.0] * 30 + [1.0] * 30,)], "v array<double>")
    assert len(df.select(U.resample(F.col("v"), 2, 1).alias("x")).first()["x"]) == 30
    loss = df.select(U.variation_loss(F.col("v"), F.transform("v", lambda x: x)).alias("x")).first()["x"]
    assert loss == pytest.approx(0.4 * (1.0 * 0.1 + 1e-8 * (29 + 29 * 0.1)) / 59, rel=1e-6)
    assert df.select(U.combined_loss({"a": F.lit(2.0), "b": F.lit(3.0)}, {"a": 0.5}).alias("x")).first()["x"] == 4.0


def test_progress(spark, tmp_path):
    assert monitor.progress_line(50, 200, 10.0) == "50/200 (25.0 %) 5.0 rows/s, 00:00:10 gone, 00:00:30 left"
    assert monitor.progress_line(0, 0, 0.0).endswith("--:--:-- left")
    df, seen = monitor.observed(spark.createDataFrame([("",), ("e",), (None,)], "error string"), "error")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 3, "ok": 2, "failed": 1}
    listener = monitor.StreamMonitor()
    spark.streams.addListener(listener)
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text('{"a": 1}\n{"a": 2}\n')
    q = spark.readStream.schema("a int").json(str(tmp_path / "in")).writeStream.format("noop").trigger(availableNow=True).start()
    q.awaitTermination()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    spark.streams.removeListener(listener)
    assert sum(r["rows"] for r in listener.reports) == 2 and listener.ended


def test_readers_and_targets(spark, tmp_path, monkeypatch):
    spark.range(100).write.parquet(f"{tmp_path}/t")
    monkeypatch.setenv(media.READER_VARIABLE, "pq")
    rows = media.open_reader(spark, None, f"{tmp_path}/t", order=["id"], offset=10, limit=25, batch=10).collect()
    assert [(r["id"], r["batch"]) for r in rows] == [(i, (i - 10) // 10) for i in range(10, 35)]
    assert [r["id"] for r in media.open_reader(spark, "parquet", f"{tmp_path}/t", order=["id"], offset=95).collect()] == [95, 96, 97, 98, 99]
    with pytest.raises(ValueError):
        media.open_reader(spark, "parquet", "x", offset=3)
    with pytest.raises(ValueError):
        media.open_reader(spark, "lance", "x")
    assert sinks.output_targets(["a.jsonl"], "/o/x.jsonl", False) == ({"a.jsonl": "/o/x.jsonl"}, "/o/x.jsonl.failed.log")
    assert sinks.output_targets(["a", "b"], "/o/", True) == ({"a": "/o/a", "b": "/o/b"}, "/o/failed_records.log")
    with pytest.raises(ValueError):
        sinks.output_targets(["a", "b"], "/o/x.jsonl", False)
    assert not sinks.is_done(spark, f"{tmp_path}/none") and sinks.is_done(spark, f"{tmp_path}/t")
    sinks.mark_done(spark, f"{tmp_path}/empty")
    assert exists(spark, f"{tmp_path}/empty/_SUCCESS") and not sinks.is_done(spark, f"{tmp_path}/empty")


def test_allocation_goes_round(spark):
    taken = spark.createDataFrame([(8,), (1,)], "id long")
    got = resume.allocate(spark, 10, taken, "id", 7, 4)
    assert [r["id"] for r in got.orderBy("ahead").collect()] == [7, 9, 0, 2]
    assert resume.next_cursor(got, "id", 10, 7) == 3
    assert resume.allocate(spark, 0, taken, "id", 0, 4).count() == 0 and resume.next_cursor(got.limit(0), "id", 10, 7) == 7
