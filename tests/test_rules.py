"""Golden cases and properties of the rules, with expected values worked out by hand."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from cadenza.functions import arrays as A
from cadenza.functions import sampling as H
from cadenza.functions import text as X
from cadenza.operators import aggregates as G
from cadenza.operators import backends as B
from cadenza.operators import joins as J
from cadenza.operators import partitioning as P
from cadenza.operators import quality as Q
from cadenza.operators import reshape as R
from cadenza.operators import resume as Z
from cadenza.operators import sequences as S
from cadenza.sources import jsonl, media, sinks
from cadenza.streaming import incremental


def value(spark, column, **row):
    return spark.range(1).select(*[v.alias(k) for k, v in row.items()]).select(column.alias("x")).first()["x"]


def lit(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_cut_plan_numbers_before_it_filters(spark):
    rows = [("s", "intro", 0.0, 10.0, 59.0), ("s", "verse", 10.0, 30.0, 59.0), ("s", "silence", 30.0, 32.0, 59.0), ("s", "verse", 32.0, 32.1, 59.0), ("s", "chorus", 32.1, 60.0, 59.0)]
    df = spark.createDataFrame(rows, "song string, label string, start double, end double, duration double")
    got = R.cut_plan(S.number_occurrences(df, ["song"], "label", ["start"])).orderBy("start").collect()
    assert [(r["label_numbered"], r["clip_start"], r["clip_end"]) for r in got] == [("intro1", 0, 10), ("verse1", 10, 30), ("chorus1", 32.1, 59)]


def test_keyed_merge_takes_the_first_that_is_not_null(spark):
    a = spark.createDataFrame([("x", None, 1, 0)], "k string, f int, g int, o int")
    b = spark.createDataFrame([("x", 2, 3, 1), (None, None, 9, 2)], "k string, f int, g int, o int")
    assert [tuple(r) for r in J.keyed_merge([b, a], "k", ["o"]).select("k", "f", "g").collect()] == [("x", 2, 1)]
    assert [tuple(r) for r in J.merge_conflicts([a, b], "k", ["o"]).collect()] == [("g", "1", 1)]


def naive_repeat(text, longest=200):
    for size in range(2, longest + 1):
        m = re.search("(.{%d})\\1+" % size, text, flags=re.S)
        if m:
            return m.group(1), len(m.group(0)) // size
    return None, 0


def test_repeat_equals_the_definition():
    assert Q.find_repeat("la la la la la la la la".strip()) == ("la ", 7)
    assert Q.find_repeat(("haha " + "one two three " * 8).strip()) == ("ha", 2)
    rng = random.Random(3)
    for _ in range(1500):
        text = "".join(rng.choice("ab\né😀") for _ in range(rng.randrange(0, 40)))
        assert Q.find_repeat(text) == naive_repeat(text)


def test_bad_transcripts(spark):
    limits = Q.Limits(never=10, least=10)
    text = F.lit("la la la la la la la la")
    why = Q.reasons(text, F.lit(100.0), limits, Q.repeated_chunk(text))
    assert lit(spark, why) == ["repeated_chunk"]
    assert lit(spark, Q.fixed(text, why, Q.repeated_chunk(text))) == "la la la "
    assert lit(spark, Q.reasons(F.lit("ab" * 499), F.lit(1.0), Q.Limits())) == []
    assert lit(spark, Q.reasons(F.lit("a" * 1200), F.lit(1.0), Q.Limits())) == ["hard_same_char_run"]
    assert lit(spark, X.has_long_run(F.lit("aaaaa"), 5)) is False
    assert lit(spark, X.has_long_run(F.lit("aaaaaa"), 5)) is True
    assert lit(spark, X.has_long_run(F.lit("\n" * 6), 5)) is False


def test_changes_and_buckets(spark):
    rows = [(1.0, []), (2.0, ["piano"]), (3.0, ["piano"]), (4.0, [])]
    df = spark.createDataFrame(rows, "t double, active array<string>").withColumn("song", F.lit("s"))
    got = S.change_points(df, ["song"], F.col("active"), ["t"], initial=F.array().cast("array<string>")).orderBy("t").collect()
    assert [(r["t"], r["active"]) for r in got] == [(2.0, ["piano"]), (4.0, [])]
    rows = [("s", 0.0, 10.0, "piano"), ("s", 10.0, 20.0, "piano"), ("s", 10.0, 20.0, "voice")]
    spans = G.bucket_union(spark.createDataFrame(rows, "song string, time double, end double, name string"), ["song"], "time", "end", "name", F.lit(60.0))
    assert [(r["names"], r["start"], r["end"]) for r in spans.orderBy("start").collect()] == [("piano", 0, 10), ("piano, voice", 10, 25)]


def fold(v):
    v = list(v)
    while len(v) > 2 and v[1][0] - v[0][0] < 1:
        v[0:2] = [(v[0][0], v[1][1])]
    while len(v) > 2 and v[-1][0] - v[-2][0] < 1:
        del v[-2]
    while len(v) > 2 and v[0][1] == v[1][1] and v[1][0] <= 10:
        del v[1]
    while len(v) > 2 and v[-2][1] == v[-3][1] and v[-1][0] - v[-2][0] <= 10:
        del v[-2]
    return v


def test_rule_fold(spark):
    rng = random.Random(5)
    cases = [[(0, "silence"), (0.5, "intro"), (8, "intro"), (20, "verse"), (39.5, "outro"), (40, "end")], [(0, "a")], [(0, "a"), (0.1, "end")]]
    for _ in range(150):
        t = sorted(rng.choice([0, 0.3, 0.9, 1.5, 2, 5, 9, 12, 20, 30, 30.5, 31]) for _ in range(rng.randrange(1, 9)))
        cases.append([(x, rng.choice("ab")) for x in t])
    df = spark.createDataFrame([(i, [(float(t), s) for t, s in c]) for i, c in enumerate(cases)], "i int, v array<struct<t:double,label:string>>")
    got = {r["i"]: [(p["t"], p["label"]) for p in r["x"]] for r in df.select("i", S.rule_fold(F.col("v")).alias("x")).collect()}
    assert all(got[i] == [(float(t), s) for t, s in fold(c)] for i, c in enumerate(cases))
    assert got[0] == [(0, "intro"), (20, "verse"), (40, "end")]


def test_tempo(spark):
    df = spark.createDataFrame([("a", t) for t in (0.0, 0.5, 1.0, 5.0, 5.05)] + [("b", 1.0)], "song string, t double")
    got = {r["song"]: r["bpm"] for r in G.tempo(df, ["song"], "t", ["t"]).collect()}
    assert got == {"a": 120.0, "b": None}


def test_hash_choices(spark):
    key = F.lit("f.jsonl:1:/a/b.mp3")
    assert lit(spark, H.length_class(key, F.lit("paragraph"))) == "SHORT"
    assert lit(spark, H.length_class(key, F.lit("sections"))) == "LONG"
    assert lit(spark, H.seed(key)) == "a0061387"
    assert lit(spark, H.weighted_choice(key, {"a": 0, "b": 0}, "d")) == "d"


def test_agreement(spark):
    a = spark.createDataFrame([("s", 0.0, "a"), ("s", 10.0, "b"), ("s", 20.0, "end")], "song string, t double, l string")
    b = spark.createDataFrame([("s", 0.0, "a"), ("s", 12.0, "b"), ("s", 20.0, "end")], "song string, t double, l string")
    assert G.agreement(a, b, ["song"], "t", "l").first()["agreement"] == pytest.approx(0.9)


def test_blocks_and_overlaps(spark):
    text = F.lit("[verse] [00:00:10.000]\nhi\n[chorus] [00:00:20.500]\nyo\n[00:00:30.000]")
    blocks = lit(spark, R.parse_blocks(text))
    assert [tuple(b) for b in blocks] == [("verse", 10.0, 20.5, "hi"), ("chorus", 20.5, 30.0, "yo")]
    spans = F.array(*[F.struct(F.lit(s).alias("start"), F.lit(e).alias("end")) for s, e in ((0.0, 20.51), (20.51, 40.0))])
    assert [r["asr_text"] for r in lit(spark, R.segments_of_old_format(spans, text))] == ["hi", "yo"]
    assert [r["asr_text"] for r in lit(spark, R.segments_of_old_format(spans, F.lit(None).cast("string")))] == ["", ""]


def test_splits(spark):
    df = spark.range(10).select(F.col("id").alias("k"))
    sizes = lambda d, c: [r["count"] for r in d.groupBy(c).count().orderBy(c).collect()]
    assert sizes(P.balanced_ranks(df, "k", 3), "rank") == [4, 3, 3]
    assert sizes(P.ranks_rest_last(df, "k", 3), "rank") == [3, 3, 4]
    many = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"))
    got = P.row_numbers(many, "k", target=300)
    assert got.filter("rn <> k + 1").count() == 0 and got.count() == 5000


def test_text_rules(spark):
    assert lit(spark, X.seconds_to_clock(F.lit(59.5))) == lit(spark, X.seconds_to_clock(F.lit(60.5))) == "00:01:00"
    assert lit(spark, X.strip_language_tag(F.lit("<|zh|> 你好"))) == "你好"
    assert lit(spark, X.py_strip(F.lit("　 a\x1c"))) == "a"
    assert tuple(lit(spark, X.scrub_output(F.lit("<think>x</think> b"), False))) == ("leak", None)
    assert tuple(lit(spark, X.scrub_output(F.lit("<think>a</think> b"), True))) == ("ok", "b")
    assert tuple(lit(spark, X.scrub_output(F.lit("<think>a</think>"), True))) == ("empty", None)
    assert lit(spark, X.parse_prompt(F.lit('x {"prompt":" hi "} y'))) == "hi"
    assert lit(spark, X.parse_prompt(F.lit("{}"))) is None and lit(spark, X.parse_prompt(F.lit("no json"))) is None
    assert lit(spark, X.path_suffix(F.lit("/a/.hidden"))) == "" and lit(spark, X.path_stem(F.lit("/a/b.tar.GZ"))) == "b.tar"
    assert lit(spark, A.millis(F.lit(1.001))) == int(round(1.001, 3) * 1000)


def test_path_fallback_is_by_presence(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"audio_path": null, "url": "u"}\n\n{"url": "u"}\nnot json\n[1]\n')
    good, bad = jsonl.read_jsonl(spark, str(tmp_path), "audio_path string, url string")
    assert good.count() == 2 and bad.count() == 2
    maps = jsonl.read_lines(spark, str(tmp_path)).filter("line LIKE '{%'").select(jsonl.record_path(F.from_json("line", "map<string,string>")).alias("p"))
    assert sorted((r["p"] for r in maps.collect()), key=str) == [None, "u"]
    with pytest.raises(Exception, match="not a JSON object"):
        jsonl.read_jsonl_strict(spark, str(tmp_path), "url string").collect()


def test_resume(spark):
    log = spark.createDataFrame([("a", 1, True), ("b", 1, False), ("c", 1, True), ("c", 2, False)], "k string, o int, ok boolean")
    inputs = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "k string")
    assert sorted(r["k"] for r in Z.to_retry(inputs, log, ["k"], ["o"], F.col("ok")).collect()) == ["b", "c", "d"]
    progress = spark.createDataFrame([(5, 1.0, None), (7, 2.0, None), (None, None, 1), (None, None, 1), (None, None, 3)], "total_tasks long, timestamp double, task_id long")
    assert tuple(Z.progress(progress).first()) == (7, 2, 5)


def test_backend_isolates_a_bad_row(spark):
    class Flaky(B.StubText):
        def generate(self, rows):
            if any(r["k"] == "bad" for r in rows):
                raise ValueError("no")
            return [{self.field: f"stub {r[self.key]}"} for r in rows]

    df = spark.createDataFrame([("x",), ("bad",), ("y",)], "k string")
    got = {r["k"]: (r["caption"], r["error"]) for r in B.run_backend(df, lambda: Flaky("k", "caption"), "caption STRING", attempts=1).collect()}
    assert got["bad"] == (None, "ValueError: no") and got["x"][0].startswith("stub ") and got["x"][1] is None
    waits = []
    with pytest.raises(ZeroDivisionError):
        B.with_retry(lambda: 1 / 0, attempts=7, sleep=waits.append)
    assert len(waits) == 6 and max(waits) <= 8.8


def test_overlap_join_equals_brute_force(spark):
    rng = random.Random(1)
    a = [(i, s := rng.uniform(-20, 50), s + rng.choice([0.0, 1.0, 30.0])) for i in range(60)]
    b = [(i, s := rng.uniform(-20, 50), s + rng.choice([0.0, 2.0, 15.0])) for i in range(60)]
    left = spark.createDataFrame([(1, *x) for x in a], "g int, i int, start double, end double")
    right = spark.createDataFrame([(1, *x) for x in b], "g int, j int, start_r double, end_r double")
    got = sorted((r["i"], r["j"]) for r in J.overlap_join(left, right, ["g"], 0.02, 5.0).collect())
    assert got == sorted((i, j) for i, s, e in a for j, s2, e2 in b if min(e, e2) - max(s, s2) >= 0.02)


def test_sinks_and_stream(spark, tmp_path):
    df = spark.createDataFrame([("a", "", "k"), ("b", "oops", "k")], "audio_path string, error string, secret_key string")
    sinks.split_write(df, F.col("error"), str(tmp_path / "good"), str(tmp_path / "bad"))
    kept = spark.read.json(str(tmp_path / "good"))
    assert kept.count() == 1 and "secret_key" not in kept.columns and spark.read.json(str(tmp_path / "bad")).first()["audio_path"] == "b"
    landing = tmp_path / "in"
    landing.mkdir()
    args = dict(schema="k string, v int", step=lambda d: d, out=str(tmp_path / "out"), checkpoint=str(tmp_path / "cp"), key=["k"])
    for i, lines in enumerate(([("a", 1), ("b", 2)], [("b", 3), ("c", 4)])):
        (landing / f"{i}.json").write_text("\n".join(json.dumps({"k": k, "v": v}) for k, v in lines))
        incremental.run_new(spark, str(landing), **args)
    assert sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [("a", 1), ("b", 2), ("c", 4)]


def test_readers(spark, tmp_path):
    (tmp_path / "a.mp3").write_bytes(b"12")
    assert media.open_reader(spark, "dir", str(tmp_path)).first()["length"] == 2
    with pytest.raises(ValueError, match="no reader"):
        media.open_reader(spark, "tape", "x")


def test_hit_rate(spark):
    t = spark.createDataFrame([("s", x) for x in (0.0, 10.0, 20.0)], "g string, t double")
    f = spark.createDataFrame([("s", x) for x in (0.2, 0.4, 19.8, 40.0)], "g string, t double")
    r = G.boundary_hit_rate(t, f, ["g"], "t", 0.5).first()
    assert (r["precision"], r["recall"]) == (0.5, pytest.approx(2 / 3))
