"""Trained operators: exact base figures, probabilities that sum to one, held-out accuracy."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cadenza.llm import quality, suffixtree, toxicity
from cadenza.llm.suffixtree import END, START, Tree, walk

from .fixtures import SCHEMA, docs, pairs, rows

DATA = "/root/testdata/sf0.01"
LOW = {i: i + 32 for i in range(65, 91)}


def held(d, modulus, rest):
    return zlib.crc32(("" if d is None else str(d)).encode()) % modulus == rest


def test_suffix_tree_base(spark):
    table = docs(spark)
    found = [(d, [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW)), None]) for d, t in pairs(table)]
    counts = Counter(w for d, t in found if not held(d, 10, 0) for w in t)
    n, v = sum(counts.values()), len(counts)
    got = rows(suffixtree.score(table), "doc_id", "n_tokens", "n_known", "train_tokens", "held_out", "base_score")
    want = sorted(((d, len(t), sum(counts[w] > 0 for w in t), n, held(d, 10, 0), sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)) for d, t in found), key=lambda t: [(x is None, str(type(x)), x if x is not None else 0) for x in t])
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want])
    assert suffixtree.score(spark.createDataFrame([], SCHEMA)).count() == 0


def test_suffix_tree_learns_and_sums_to_one(spark, monkeypatch):
    trees = []
    grow = suffixtree.grow
    monkeypatch.setattr(suffixtree, "grow", lambda *a: trees.append(grow(*a)) or trees[-1])
    lot = [(i, "the cat sat on the mat and then " * 3 + ("it ran" if i % 2 else "it slept well")) for i in range(120)]
    got = suffixtree.score(spark.createDataFrame(lot, "doc_id long, text string")).filter("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert got["s"] > got["b"] * 0.5
    tree: Tree = trees[0]
    words = tree.words
    assert sum(len(s) for s in tree.states) > 3
    other = np.uint64(12345)
    for context in (START, *words[:6]):
        for before in (np.uint64(0), *words[:4]):
            hashes = np.append(words, other)
            one = np.full(len(hashes), context)
            two = np.full(len(hashes), suffixtree.mix(np.array([before], dtype=np.uint64) * suffixtree._TWO + context)[0] if before else np.uint64(0))
            base, _, _, more = walk(tree, suffixtree.Tokens(hashes, one, two, np.array([0, len(hashes)])))
            rest = 1 - float((10 ** tree.base[tree.known]).sum())
            base[-1] = math.log10(rest)
            base[:-1][~tree.known] = -np.inf
            assert float((10 ** (base + more)).sum()) == pytest.approx(1, abs=1e-6)
    assert END in words


def auc(score, label):
    order = np.argsort(np.argsort(score))
    pos = label == 1
    return (order[pos].sum() - pos.sum() * (pos.sum() - 1) / 2) / (pos.sum() * (~pos).sum())


def planted(n, seed):
    rng = np.random.default_rng(seed)
    texts, toxic, good = [], [], []
    for i in range(n):
        w = [f"w{x}" for x in rng.integers(0, 300, rng.integers(8, 60))]
        toxic.append(int(rng.random() < 0.25))
        good.append(int(rng.random() < 0.7))
        if toxic[-1]:
            w.insert(int(rng.integers(0, len(w))), rng.choice(["scumly", "idiotic", "vilest"]))
        if not good[-1]:
            w = [x.upper() + "!!" for x in w]
        texts.append(" ".join(w))
    return texts, toxic, good


@pytest.fixture(scope="module")
def corpus(spark):
    texts, toxic, good = planted(900, 3)
    lot = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)] + [(5000, None, None, None, None), (5001, "", "", "", 0), (None, "x", "en", "s", 1), (3, texts[3], "en", "s", 1)]
    df = spark.createDataFrame(lot, "doc_id long, text string, lang string, source string, score long")
    labels = spark.createDataFrame([(i, g, t) for i, (g, t) in enumerate(zip(good, toxic))] + [(7, None, None), (None, 1, 1), (5000, 1, 0)], "doc_id long, quality int, toxic int")
    return df, labels, {i: (g, t) for i, (g, t) in enumerate(zip(good, toxic))}


def test_toxicity(spark, corpus):
    df, labels, truth = corpus
    got = toxicity.score(df, toxicity.train(df, labels)).collect()
    assert len(got) == df.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    out = [(r["score"], truth[r["doc_id"]][1]) for r in got if r["held_out"] and r["doc_id"] in truth]
    s, y = map(np.array, zip(*out))
    assert auc(s, y) > 0.97
    assert all(r["held_out"] == held(r["doc_id"], 5, 0) for r in got)
    none = toxicity.score(df, toxicity.train(df, labels.limit(0)))
    assert {r["score"] for r in none.collect()} == {0.5}
    assert toxicity.score(df.limit(0), toxicity.train(df, labels)).count() == 0


def test_quality(spark, corpus):
    df, labels, truth = corpus
    got = quality.score(df, quality.train(df, labels)).collect()
    assert len(got) == df.count() and {r["_score"] for r in got} == {r["score"] for r in df.collect()} and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)
    out = [(r["score"], truth[r["doc_id"]][0]) for r in got if r["held_out"] and r["doc_id"] in truth]
    s, y = map(np.array, zip(*out))
    assert auc(s, y) > 0.98 and ((s >= 0.7) == (y == 1)).mean() > 0.95
    assert {r["score"] for r in quality.score(df, quality.train(df, labels.limit(0))).collect()} == {0.5}


def test_held_out_accuracy_on_the_driver_tables(spark):
    df, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    for module, label, least in ((quality, "quality", 0.95), (toxicity, "toxic", 0.9)):
        got = module.score(df.select("doc_id", "text"), module.train(df, labels)).filter("held_out").join(labels, "doc_id").select("score", label).collect()
        s, y = map(np.array, zip(*[(r["score"], r[label]) for r in got]))
        assert auc(s, y) > least


def test_word_vectors_are_sums_over_all_texts(spark, monkeypatch):
    texts = ["a b c a", "b", "", None, "a b x y z a b"] * 3
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    want = np.zeros((quality.BUCKETS, quality.DIM))
    one = lambda w: int(next(quality._slices([w])).hashes()[0])
    for t in texts:
        w = (t or "").split()
        for i in range(len(w)):
            for j in range(max(0, i - 2), min(len(w), i + 3)):
                if i != j:
                    for place, sign in quality._places(np.array([one(w[j])], dtype=np.uint64)):
                        want[one(w[i]) % quality.BUCKETS, place[0]] += sign[0]
    want /= np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1e-9)
    assert np.allclose(quality.word_vectors(df), want, atol=1e-6)


def test_word_vectors_take_little_memory():
    """4 MB of text at once took 100 MB of arrays beside the sums; a slice of them a worker's share."""
    import tracemalloc

    rng = np.random.default_rng(2)
    batch = pa.RecordBatch.from_pydict({"text": [" ".join(map(str, rng.integers(0, 10**5, 1000))) for _ in range(700)]})
    total = np.zeros((quality.BUCKETS, quality.DIM))
    tracemalloc.start()
    for _, _, data, offsets in quality.text_slices(batch, limit=quality.SLICE):
        quality.add_contexts(total, quality.split(data, offsets, quality.NOT_SPACE, quality.AS_IS))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6 and np.abs(total).sum() > 0


def test_texts_reach_workers_in_small_batches(spark, monkeypatch):
    """Sums of contexts, the fit and the pipeline's stages: none hands a worker the session's 10,000 rows at once."""
    import corpus_pipeline

    from cadenza import storage

    monkeypatch.setattr(storage, "BATCH_ROWS", 50)
    rows = spark.range(400, numPartitions=1)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array([b.num_rows], type=pa.int64())})

    seen = corpus_pipeline._written(spark, "sizes", rows.mapInArrow(sizes, "doc_id long"))
    assert {r["doc_id"] for r in seen.collect()} == {50}
    assert {r["doc_id"] for r in rows.mapInArrow(sizes, "doc_id long").collect()} == {400}


def test_words_drop_tokenizers():
    from cadenza.llm import words

    words.KEPT["x"] = object()
    list(words.text_slices(pa.RecordBatch.from_pydict({"text": ["a"]})))
    assert not words.KEPT


def test_a_repeated_id_gives_one_sample_row(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c"), (None, "d")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, None)], "doc_id long, quality int")
    assert [tuple(r) for r in quality.sample(df, labels, "quality", 10**6, -1, 10).collect()] == [(1, "a", 1)]


def test_temperature_calibrates():
    rng = np.random.default_rng(1)
    z = rng.normal(0, 2, 4000)
    y = (rng.random(4000) < 1 / (1 + np.exp(-z))).astype(float)
    assert quality.temperature(z * 4, y) == pytest.approx(4, rel=0.2)
