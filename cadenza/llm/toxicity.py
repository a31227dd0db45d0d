"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the distinct hashed words, word stems (the first four and six bytes of longer words), bigrams and
one-word skip-grams of a whole text. Each coordinate has its own learning rate; the L1 term leaves few weights that are
not zero, and those (at most ``2**BITS``) are broadcast for scoring. Labels are learned from a sample of at most
``MAX_ROWS`` labelled rows; scoring covers every row and every word.

Defined results: null text is empty and scores by the bias alone; without any label all scores are 0.5;
repeated rows give repeated rows.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import id_and_text
from cadenza.llm.labelled import fit_in_one_task, remainder, sample
from cadenza.llm.words import ALNUM, LOWER, U64, Words, hash_spans, mix, split, text_slices

BITS = 20
MAX_ROWS = 20_000
HELD_MODULUS, HELD = 5, 0
STEMS = (4, 6)


def grams(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word position, feature) of every n-gram, stem and skip-gram."""
    h = words.hashes()
    at = np.arange(len(h))
    last = np.repeat(words.ptr[1:], np.diff(words.ptr)) if len(h) else at
    yield at, (h >> U64(64 - BITS)).astype(np.int64)
    for i, n in enumerate(STEMS):
        long = np.flatnonzero(words.lens > n)
        yield long, (hash_spans(words.data, words.starts[long], np.full(len(long), n), seed=i + 1) >> U64(64 - BITS)).astype(np.int64)
    for gap, salt in ((1, U64(0x9E3779B97F4A7C15)), (2, U64(0xC2B2AE3D27D4EB4F))):
        first = np.flatnonzero(at + gap < last)
        yield first, (mix(h[first] * salt + h[first + gap]) >> U64(64 - BITS)).astype(np.int64)


def features(texts: list[str]) -> list[np.ndarray]:
    """Each text's distinct features."""
    batch = pa.RecordBatch.from_arrays([pa.array(texts, type=pa.string())], names=["text"])
    out = []
    for _, _, data, offsets in text_slices(batch):
        words = split(data, offsets, ALNUM, LOWER)
        doc = np.repeat(np.arange(len(offsets) - 1), np.diff(words.ptr))
        keys = np.unique(np.concatenate([(doc[at] << BITS) | f for at, f in grams(words)]))
        cuts = np.searchsorted(keys, np.arange(1, len(offsets) - 1) << BITS)
        out += [k & ((1 << BITS) - 1) for k in np.split(keys, cuts)]
    return out


class Ftrl:
    """FTRL-proximal over 0/1 features; index ``2**BITS`` is the bias, which has no L1 term."""

    def __init__(self, alpha: float = 0.5, beta: float = 1.0, l1: float = 6.0, l2: float = 0.1):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        l1 = np.where(at == 1 << BITS, 0.0, self.l1)
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2))

    def learn(self, found: np.ndarray, label: int) -> None:
        at = np.append(found, 1 << BITS)
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        root = np.sqrt(self.n[at])
        self.n[at] += g * g
        self.z[at] += g - (np.sqrt(self.n[at]) - root) / self.alpha * w


def fit(rows: pd.DataFrame, epochs: int = 4) -> bytes:
    """The sparse weights, as an .npz file."""
    model = Ftrl()
    order = np.random.default_rng(7)
    for _ in range(epochs if len(rows) else 0):
        turn = order.permutation(len(rows))
        for at in range(0, len(turn), 200):
            some = rows.iloc[turn[at : at + 200]]
            for found, label in zip(features(some["text"].tolist()), some["label"]):
                model.learn(found, int(label))
    every = np.arange((1 << BITS) + 1)
    w = model.weights(every)
    index = np.flatnonzero(w)
    out = io.BytesIO()
    np.savez_compressed(out, index=index, weight=w[index])
    return out.getvalue()


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = MAX_ROWS) -> bytes:
    return fit_in_one_task(sample(docs, labels, label, HELD_MODULUS, HELD, max_rows), fit)


def score(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    stored = np.load(io.BytesIO(model))
    shared = docs.sparkSession.sparkContext.broadcast((stored["index"], stored["weight"]))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, weight = shared.value
        table = np.zeros((1 << BITS) + 1)
        table[index] = weight
        live = table != 0
        for batch in batches:
            out = np.full(batch.num_rows, table[-1])
            for first, last, data, offsets in text_slices(batch):
                words = split(data, offsets, ALNUM, LOWER)
                doc = np.repeat(np.arange(last - first), np.diff(words.ptr))
                keys = []
                for at, f in grams(words):
                    some = np.flatnonzero(live[f])
                    keys.append((doc[at[some]] << BITS) | f[some])
                keys = np.unique(np.concatenate(keys))
                out[first:last] += np.bincount(keys >> BITS, weights=table[keys & ((1 << BITS) - 1)], minlength=last - first)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(out, -35, 35))))], names=["doc_id", "score"])

    rows = id_and_text(docs, id_col, text_col).mapInArrow(scored, "doc_id long, score double")
    return rows.select("doc_id", (remainder("doc_id", HELD_MODULUS) == HELD).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
