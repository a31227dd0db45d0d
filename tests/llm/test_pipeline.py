"""The pipeline: each stage on its predecessor's rows, against brute force."""

import corpus_pipeline
from pyspark.sql import functions as F

from cadenza.llm import queries

from .test_exact import contaminated, near

DATA = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    kept = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, DATA)
        out.write.parquet(str(tmp_path / str(i)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(i)))
        if i < 4:
            assert docs.columns == before.columns
            kept[i] = {r["doc_id"]: r["text"] for r in docs.collect()}
    score = {r["doc_id"]: r["predicted"] for r in queries.op8_quality(spark, DATA).collect()}
    every = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    assert kept[0] == {d: t for d, t in every.items() if score[d]}
    last = {}
    for d, t in kept[0].items():
        last[t] = max(d, last.get(t, d))
    assert set(kept[1]) == set(last.values())
    assert set(kept[2]) == {d for d, _, _, k in near(sorted(kept[1].items())) if k}
    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    assert set(kept[3]) == {d for d, _, _, _, c in contaminated(sorted(kept[2].items()), items) if not c}
    assert {r["doc_id"] for r in docs.collect()} == set(kept[3])


def test_stages_bear_repeated_ids_and_nulls(spark):
    """An id with several texts: each text is a document of its own."""
    base = " ".join(f"w{i}" for i in range(40))
    item = spark.read.parquet(f"{DATA}/benchmark.parquet").filter("text IS NOT NULL").first()["text"]
    lot = [(5, "first text of five", "en"), (5, base, None), (5, item, "en"), (9, base, "de"), (None, "first text of five", "en"), (None, None, None), (7, None, "en"), (7, None, "en"), (8, base + " more", "en"), (3, "", "en"), (None, "alone", None), (6, "x " * 50_000, "en")]
    docs = spark.createDataFrame([(i, t, lang, None, len(t or "")) for i, t, lang in lot], "doc_id long, text string, lang string, source string, n_chars long").withColumn("_id", F.lit(1)).withColumn("copies", F.lit("x"))
    plain = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)
    exact = corpus_pipeline.exact_deduplication(spark, docs, DATA)
    assert plain(exact) == sorted([(5, "first text of five"), (5, item), (9, base), (7, None), (7, None), (8, base + " more"), (None, "alone"), (6, "x " * 50_000)], key=str)
    near = corpus_pipeline.near_deduplication(spark, docs, DATA)
    assert plain(near) == sorted([(5, "first text of five"), (5, base), (5, item), (None, "first text of five"), (None, None), (7, None), (7, None), (3, ""), (None, "alone"), (6, "x " * 50_000)], key=str)
    clean = corpus_pipeline.decontamination(spark, docs, DATA)
    assert plain(clean) == sorted([(i, t) for i, t, _ in lot if t != item], key=str)
    assert all(df.columns == corpus_pipeline.COLUMNS for df in (exact, near, clean))


def test_empty(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DATA)
        assert docs.count() == 0


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 11))
