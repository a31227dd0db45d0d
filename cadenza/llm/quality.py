"""Quality: random-indexing word vectors pooled per document, and a two-layer network with calibrated probabilities.

Every word is hashed to an index vector (sparse, random) and to one of ``BUCKETS`` word vectors; there is no vocabulary. A word
vector is the sum of the index vectors of its words' neighbours over all documents: tasks add up their own sums, which are merged by ranges of
buckets, and the whole (8 MB, whatever the corpus) is broadcast. A document is the mean of its words' normalised vectors, beside the mean
of the index vectors of its words' shapes (``use_shapes``). A network of one hidden layer is trained on most of the
sample, which has at most ``MAX_ROWS`` labelled rows; a temperature fitted on the rest calibrates its probabilities. Scoring covers
every row and every word.

Defined results: null text is empty, its pooled vector is zero; without any label all scores are 0.5; repeated rows give
repeated rows; columns named score, held_out or predicted keep their values under the name with an underscore before it.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import id_and_text, small_batches
from cadenza.llm.labelled import fit_in_one_task, remainder, sample
from cadenza.llm.words import AS_IS, NOT_SPACE, U64, Words, mix, split, text_slices

MAX_ROWS = 8_000
BUCKETS, BLOCKS = 1 << 15, 64
HELD_MODULUS, HELD = 4, 2
DIM, REACH, HIDDEN = 64, 2, 32
#: Bytes of text worked on at once: a word takes some 100 bytes of arrays where contexts are added up, 400 where vectors are pooled.
SLICE = 1 << 19

_LETTER_END = np.zeros(256, dtype=np.int64)
for _i, _c in enumerate((b".", b",", b"!", b"|", b"0123456789", bytes(x for x in range(0x21, 0x7F) if not bytes([x]).isalnum() and x not in b".,!|"))):
    _LETTER_END[list(_c)] = _i + 1
_UPPER = np.zeros(256, dtype=bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_SMALL = np.zeros(256, dtype=bool)
_SMALL[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True
SHAPES = 4 * 2 * 2 * 7 * 2


def shapes(words: Words, hashes: np.ndarray) -> np.ndarray:
    """Length class, first capital, any small letter, kind of the last byte, and whether the word repeats the one before."""
    if not len(hashes):
        return np.zeros(0, dtype=np.int64)
    small = np.concatenate([[0], np.cumsum(_SMALL[words.data])])
    same = np.zeros(len(hashes), dtype=np.int64)
    same[1:] = hashes[1:] == hashes[:-1]
    same[words.ptr[:-1][words.ptr[:-1] < len(hashes)]] = 0
    length = np.searchsorted([3, 6, 11], words.lens, side="right")
    end = words.starts + words.lens
    code = length * 2 + _UPPER[words.data[words.starts]]
    code = code * 2 + (small[end] > small[words.starts])
    code = code * 7 + _LETTER_END[words.data[end - 1]]
    return code * 2 + same


def _places(h: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The four places of a hash's index vector that aren't zero, with their signs."""
    for j in range(4):
        r = mix(h * U64(4) + U64(j + 1))
        yield (r % U64(DIM)).astype(np.int64), np.where(r >> U64(63) != 0, 1, -1)


def index_vectors(n: int) -> np.ndarray:
    """Those of the numbers below n."""
    out = np.zeros((n, DIM), dtype=np.float32)
    for at, sign in _places(np.arange(n, dtype=U64)):
        np.add.at(out, (np.arange(n), at), sign)
    return out


def bucket(h: np.ndarray) -> np.ndarray:
    return (h % U64(BUCKETS)).astype(np.int64)


def add_contexts(total: np.ndarray, words: Words) -> None:
    """Adds the neighbours' index vectors to the sums by word bucket, (BUCKETS, DIM)."""
    h, out = words.hashes(), total.reshape(-1)
    own, last, at = bucket(h) * DIM, np.repeat(words.ptr[1:], np.diff(words.ptr)), np.arange(len(h))
    pairs = [(first, first + gap) for gap in range(1, REACH + 1) for first in [np.flatnonzero(at + gap < last)]]
    for place, sign in _places(h):
        sign = sign.astype(np.float64)
        for a, b in pairs:
            np.add.at(out, own[a] + place[b], sign[b])
            np.add.at(out, own[b] + place[a], sign[a])


def word_vectors(texts: DataFrame) -> np.ndarray:
    """The normalised word vectors over all texts; a task hands on one sum per block of buckets, and BUCKETS vectors are gathered."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BUCKETS, DIM))
        for batch in batches:
            for _, _, data, offsets in text_slices(batch, limit=SLICE):
                add_contexts(total, split(data, offsets, NOT_SPACE, AS_IS))
        kind = "<i4" if np.abs(total).max() < 2**31 else "<i8"
        sums = [kind.encode() + zlib.compress(p.astype(kind).tobytes(), 1) for p in total.reshape(BLOCKS, -1)]
        yield pa.RecordBatch.from_pydict({"block": pa.array(np.arange(BLOCKS), type=pa.int32()), "sums": sums})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, raw in zip(batch.column("block").to_pylist(), batch.column("sums").to_pylist()):
                part = np.frombuffer(zlib.decompress(raw[3:]), dtype=raw[:3].decode()).astype(np.int64)
                sums[b] = sums[b] + part if b in sums else part
        for b, part in sums.items():
            yield pa.RecordBatch.from_pydict({"block": pa.array([b], type=pa.int32()), "sums": [part.astype("<f4").tobytes()]})

    schema = "block int, sums binary"
    out = np.zeros((BLOCKS, BUCKETS // BLOCKS * DIM), dtype=np.float32)
    with small_batches(texts.sparkSession):
        merged = texts.select("text").mapInArrow(count, schema).repartition(16, "block").mapInArrow(merge, schema).collect()  # BLOCKS rows
    for row in merged:
        out[row["block"]] = np.frombuffer(row["sums"], dtype="<f4")
    out = out.reshape(BUCKETS, DIM)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def pooled(words: Words, vectors: np.ndarray, plain: np.ndarray) -> np.ndarray:
    """The mean word vectors of documents, and the mean index vectors of their words' shapes if ``plain`` has any."""
    n, lens = len(words.ptr) - 1, np.diff(words.ptr)
    out = np.zeros((n, DIM + (DIM if len(plain) else 0)), dtype=np.float32)
    filled = np.flatnonzero(lens)
    if not len(filled):
        return out
    h = words.hashes()
    out[filled, :DIM] = np.add.reduceat(vectors[bucket(h)], words.ptr[filled], axis=0, dtype=np.float32) / lens[filled, None]
    if len(plain):
        out[filled, DIM:] = np.add.reduceat(plain[shapes(words, h)], words.ptr[filled], axis=0) / lens[filled, None]
    return out


def _slices(texts: list[str]) -> Iterator[Words]:
    batch = pa.RecordBatch.from_arrays([pa.array(texts, type=pa.string())], names=["text"])
    for _, _, data, offsets in text_slices(batch, limit=SLICE):
        yield split(data, offsets, NOT_SPACE, AS_IS)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class Network:
    """tanh layer and a logistic output, trained by Adam."""

    def __init__(self, inputs: int, rng: np.random.Generator):
        self.p = [rng.normal(0, inputs**-0.5, (inputs, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ self.p[0] + self.p[1]) @ self.p[2] + self.p[3][0]

    def train(self, x: np.ndarray, y: np.ndarray, rng: np.random.Generator, epochs: int = 40, rate: float = 0.005, decay: float = 1e-4) -> None:
        m, v, t = [np.zeros_like(a) for a in self.p], [np.zeros_like(a) for a in self.p], 0
        for _ in range(epochs):
            turn = rng.permutation(len(x))
            for at in range(0, len(turn), 64):
                some = turn[at : at + 64]
                hidden = np.tanh(x[some] @ self.p[0] + self.p[1])
                d = (_sigmoid(hidden @ self.p[2] + self.p[3][0]) - y[some]) / len(some)
                back = np.outer(d, self.p[2]) * (1 - hidden**2)
                t += 1
                for i, g in enumerate((x[some].T @ back + decay * self.p[0], back.sum(0), hidden.T @ d + decay * self.p[2], np.array([d.sum()]))):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    self.p[i] = self.p[i] - rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)


def fit(rows: pd.DataFrame, vectors: np.ndarray, use_shapes: bool = True) -> bytes:
    texts, y = rows["text"].tolist(), rows["label"].to_numpy(dtype=np.float64)
    rng = np.random.default_rng(11)
    plain = index_vectors(SHAPES if use_shapes else 0)
    width = DIM + (DIM if use_shapes else 0)
    model = {"vectors": vectors.astype(np.float16), "plain": plain, "mean": np.zeros(width), "scale": np.ones(width), "w0": np.zeros((width, HIDDEN)), "w1": np.zeros(HIDDEN), "w2": np.zeros(HIDDEN), "w3": np.zeros(1), "heat": np.ones(1)}
    if len(y):
        x = np.concatenate([pooled(w, model["vectors"], plain) for w in _slices(texts)]).astype(np.float64)
        model["mean"], model["scale"] = x.mean(0), x.std(0) + 1e-3
        x = (x - model["mean"]) / model["scale"]
        turn = rng.permutation(len(y))
        rest, main = turn[: len(y) // 5], turn[len(y) // 5 :]
        net = Network(width, rng)
        net.train(x[main], y[main], rng)
        model |= {f"w{i}": a for i, a in enumerate(net.p)}
        if len(rest):
            model["heat"] = np.array([temperature(net.logits(x[rest]), y[rest])])
    out = io.BytesIO()
    np.savez_compressed(out, **model)
    return out.getvalue()


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits with the least cross-entropy, from 1/4 to 16."""
    heats = 2 ** np.linspace(-2, 4, 121)
    loss = [np.mean(np.logaddexp(0, logits / t) - y * logits / t) for t in heats]
    return float(heats[int(np.argmin(loss))])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS, use_shapes: bool = True) -> bytes:
    """Word vectors of all texts of ``docs``, and a network fitted on a bounded sample of the labelled ones."""
    shared = docs.sparkSession.sparkContext.broadcast(word_vectors(id_and_text(docs)))
    model = fit_in_one_task(sample(docs, labels, label, HELD_MODULUS, HELD, max_rows), lambda rows: fit(rows, shared.value, use_shapes))
    shared.destroy()
    return model


def score(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The columns of ``docs``, then held_out, score and predicted of each row; no shuffle."""
    for name in ("score", "held_out", "predicted"):
        docs = docs.withColumnRenamed(name, f"_{name}")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.withColumn("score", F.lit(0.0))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = np.load(io.BytesIO(shared.value))
        m = {k: m[k] for k in m.files}
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for first, last, data, offsets in text_slices(batch, text_col, limit=SLICE):
                x = (pooled(split(data, offsets, NOT_SPACE, AS_IS), m["vectors"], m["plain"]) - m["mean"]) / m["scale"]
                out[first:last] = _sigmoid((np.tanh(x @ m["w0"] + m["w1"]) @ m["w2"] + m["w3"][0]) / m["heat"][0])
            columns = dict(zip(batch.schema.names, batch.columns)) | {"score": pa.array(out)}
            yield pa.RecordBatch.from_arrays([columns[n] for n in batch.schema.names], names=batch.schema.names)

    rows = rows.mapInArrow(scored, rows.schema)
    return rows.withColumns({"held_out": remainder(id_col, HELD_MODULUS) == HELD, "predicted": (F.col("score") >= threshold).cast("int")})
