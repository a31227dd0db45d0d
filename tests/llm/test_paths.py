"""Compacted paths stand for their nodes, and are verified at their coordinates."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.llm import debruijn

from .fixtures import SCHEMA, docs, pairs, rows, same


def test_documents_get_paths_not_their_nodes(spark, monkeypatch):
    seen = []
    windows = debruijn._windows
    monkeypatch.setattr(debruijn, "_windows", lambda t: seen.extend(t.select("marks").collect()) or windows(t))
    passage = " ".join(f"p{i}" for i in range(300))
    lot = [(i, f"a{i} {passage} z{i}", "en", "s", 0, "r", "k", 1, 2, "n") for i in range(3)]
    got = rows(debruijn.repeated_spans(spark.createDataFrame(lot, SCHEMA)), "doc_id", "n_words", "n_removed")
    assert got == [(i, 302, 300) for i in range(3)]
    assert len(seen) == 3
    assert all(max(m["length"] for m in r["marks"]) > len(r["marks"]) for r in seen)


def test_results_come_from_compacted_paths(spark, monkeypatch):
    """Without compaction the long passage isn't found: its nodes reach the documents by their paths alone."""
    passage = " ".join(f"p{i}" for i in range(300))
    df = spark.createDataFrame([(i, f"a{i} {passage} z{i}", "en", "s", 0, "r", "k", 1, 2, "n") for i in range(3)], SCHEMA)
    spans = {tuple((s["start"], s["end"]) for s in r["spans"]) for r in debruijn.repeated_spans(df).collect()}
    assert spans == {((1, 301),)}
    compacted = debruijn.compacted
    monkeypatch.setattr(debruijn, "compacted", lambda nodes, scratch: compacted(nodes, scratch).withColumn("path", F.lit(0).cast("long")))
    assert all(r["n_removed"] < 300 for r in debruijn.repeated_spans(df).collect())


def brute(found):
    words = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in found]
    seen = Counter(tuple(w[i : i + 35]) for _, w in words for i in range(len(w) - 34))
    out = []
    for d, w in words:
        gone = np.zeros(len(w), dtype=bool)
        for i in range(len(w) - 34):
            if seen[tuple(w[i : i + 35])] > 1:
                gone[i : i + 35] = True
        out.append((d, len(w), int(gone.sum()), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("bits", [64, 12, 7])
def test_nodes_and_edges_of_equal_hash(spark, monkeypatch, bits):
    """With hashes of few bits, paths come up whose spans differ; verification gives them up."""
    if bits < 64:
        spans, windows = debruijn._FIRST.spans, debruijn._FIRST.windows
        keep = np.uint64((1 << bits) - 1)
        short = type("Short", (), {"sums": debruijn._FIRST.sums, "spans": lambda self, s, a, b: spans(s, a, b) & keep, "windows": lambda self, s, k: windows(s, k) & keep})()
        monkeypatch.setattr(debruijn, "_FIRST", short)
    extra = [(200 + i, " ".join(f"q{j}" for j in range(120)) + f" end{i} " + " ".join(f"r{j}" for j in range(i, 90))) for i in range(3)]
    df = docs(spark, extra)
    same(rows(debruijn.repeated_spans(df), "doc_id", "n_words", "n_removed", "kept_sha256"), brute(pairs(df)))


def test_windows_at_the_ends_of_spans(spark):
    """A window that begins or ends a path's span also occurs where the path doesn't: in texts of period 30, before the first and after the last span."""
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(3000)]
    lot = [(i, " ".join(([words[j] for j in rng.integers(0, 3000, 26 + i % 15)] * 6)[: 60 + int(rng.integers(0, 100))])) for i in range(150)]
    lot += [(1000 + i, " ".join(t.split()[int(rng.integers(0, 20)) : -int(rng.integers(1, 20))])) for i, t in lot[:60]]
    df = spark.createDataFrame(lot, "doc_id long, text string")
    same(rows(debruijn.repeated_spans(df), "doc_id", "n_words", "n_removed", "kept_sha256"), brute(lot))


@pytest.mark.parametrize("share", [1, 10**9])
def test_hot_and_other_keys(spark, monkeypatch, share):
    monkeypatch.setattr(debruijn, "HOT_SHARE", share)
    df = docs(spark)
    same(rows(debruijn.repeated_spans(df), "doc_id", "n_words", "n_removed", "kept_sha256"), brute(pairs(df)))


def test_very_long_texts(spark):
    """Texts far beyond the size that is worked on at once."""
    from cadenza.llm.words import SLICE_BYTES

    rng = np.random.default_rng(5)
    words = np.array([f"w{i}" for i in range(5000)])
    passage = " ".join(words[rng.integers(0, 5000, 2000)])
    lot = [(i, " ".join(words[rng.integers(0, 5000, SLICE_BYTES // 4)]) + f" u{i} " + passage + f" v{i} " + " ".join(words[rng.integers(0, 5000, 500)])) for i in range(2)] + [(2, "x"), (3, None)]
    assert len(lot[0][1]) > SLICE_BYTES
    got = {r["doc_id"]: r["n_removed"] for r in debruijn.repeated_spans(spark.createDataFrame(lot, "doc_id long, text string")).collect()}
    assert got == {0: 2000, 1: 2000, 2: 0, 3: 0}
