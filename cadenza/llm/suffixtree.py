"""Language-model scoring by a probabilistic suffix tree over words.

States are contexts of up to two preceding tokens (a start mark counts as one). The root is the smoothed unigram distribution. A
(context, next token) pair is known when training has it ``LEAST`` times, whatever the size of the corpus; a context stays a state when its
next-token distribution diverges from its parent's by ``GAIN`` nats per occurrence, or more. A state gives its known tokens their discounted
share and passes the rest to its parent (Katz back-off), which keeps it a distribution. Scoring uses the longest suffix that is a state.

Pairs are counted exactly: tasks hand on their own sums in lots, dealt over bins by hash. A pair of a token and two before it is as frequent at
most as the two pairs of neighbours it is made of, so it is counted only if a bitmap of those lets it through (a full bitmap
lets all through; counts don't depend on it). The tree is a table. What a token adds to a score is a sum of one value for its
word, one for its pair and one for its triple, so the most frequent pairs and words (at most ``2**21`` of either) are
broadcast, and all others of a text are joined with the tables by a shuffle. Words are heavy by how often all texts have them, so one that only held-out
texts have isn't a hot key of that join.

Defined results: null text is empty and scores its end token; repeated rows give repeated rows; without training rows
N and V are 0 and every token has the base's probability 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.bitmaps import bitmap, contains
from cadenza.llm.common import HOT_SHARE, Scratch, id_and_text, salted_join
from cadenza.llm.labelled import remainder
from cadenza.llm.words import LOWER, NOT_SPACE, U64, mix, split, text_slices

HELD_MODULUS, HELD = 10, 0
LEAST = 4
GAIN = 0.01
DISCOUNT = 0.5
HEAVY = 2.0**-21
HEAVY_PAIRS = 1 << 21
CHUNK = 4_000_000
BIN_TOKENS, BINS = 2_000_000, 1024
END, START = U64(0x5E2D58D8B3BCDEE8), U64(0x9D7E1C3B5A2F4861)
_TWO, _THREE = U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F)


@dataclass
class Tokens:
    """Token hashes of some documents, an end after each; ``one`` and ``two`` are the contexts' hashes (0: none)."""

    hashes: np.ndarray
    one: np.ndarray
    two: np.ndarray
    ptr: np.ndarray


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> Tokens:
    words = split(data, offsets, NOT_SPACE, LOWER)
    n = len(words.ptr) - 1
    ptr = words.ptr + np.arange(n + 1)
    out = np.full(int(ptr[-1]), END, dtype=U64)
    inner = np.ones(len(out), dtype=bool)
    inner[ptr[1:] - 1] = False
    out[inner] = words.hashes()
    one = np.empty_like(out)
    one[1:] = out[:-1]
    one[ptr[:-1]] = START
    two = np.zeros_like(out)
    two[1:] = mix(one[:-1] * _TWO + one[1:])
    two[ptr[:-1]] = 0
    return Tokens(out, one, two, ptr)


def unigrams(texts: DataFrame) -> DataFrame:
    """(word, n, seen): each token's count in training and in all texts; a task hands on its own sums, in lots of bounded size."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        train: list[np.ndarray] = []
        size = 0

        def lot() -> pa.RecordBatch:
            keys, at, seen = np.unique(np.concatenate(held), return_inverse=True, return_counts=True)
            n = np.bincount(at, weights=np.concatenate(train), minlength=len(keys)).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n), pa.array(seen)], names=["word", "n", "seen"])

        for batch in batches:
            out = batch.column("held_out").to_numpy(zero_copy_only=False)
            for first, last, data, offsets in text_slices(batch):
                t = tokens_of(data, offsets)
                held.append(t.hashes)
                train.append(np.repeat(~out[first:last], np.diff(t.ptr)))
                size += len(held[-1])
                if size >= CHUNK:
                    yield lot()
                    held, train, size = [], [], 0
        if held:
            yield lot()

    return texts.select("text", "held_out").mapInArrow(count, "word long, n long, seen long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen"))


def pair_keys(t: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Of each token, the key of its pair with the token before and with the two before (0: none)."""
    one = mix(t.one * _TWO + t.hashes)
    return one, np.where(t.two != 0, mix(t.two * _THREE + one), U64(0))


def pair_counts(texts: DataFrame, depth: int, tokens: int, may=None) -> DataFrame:
    """(key, context, next, n) of the pairs that occur ``LEAST`` times; ``next`` is the token, or at depth 2 the key of its pair of depth 1."""
    parts = max(8, tokens // BIN_TOKENS)
    bins = max(BINS, 4 * parts)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def lot() -> pa.RecordBatch:
            keys, context, after = (np.concatenate([h[i] for h in held]) for i in range(3))
            own, at, n = np.unique(keys, return_index=True, return_counts=True)
            cuts = np.searchsorted((own >> U64(32)) * U64(bins) >> U64(32), np.arange(bins + 1).astype(U64))
            filled = np.flatnonzero(np.diff(cuts))
            edges = np.append(cuts[filled], len(own))

            def blobs(x: np.ndarray) -> pa.Array:
                return pa.Array.from_buffers(pa.binary(), len(filled), [None, pa.py_buffer((edges * x.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(x))])

            return pa.RecordBatch.from_arrays([pa.array(filled.astype(np.int32)), blobs(context[at]), blobs(after[at]), blobs(n.astype(np.uint32))], names=["bin", "context", "next", "n"])

        for batch in batches:
            for _, _, data, offsets in text_slices(batch):
                t = tokens_of(data, offsets)
                one, two = pair_keys(t)
                if depth == 1:
                    held.append((one, t.one, t.hashes))
                else:
                    at = np.flatnonzero(t.two != 0)
                    at = at[contains(may.value, one[at])]
                    at = at[contains(may.value, t.two[at])]
                    held.append((two[at], t.two[at], one[at]))
                size += len(held[-1][0])
                if size >= CHUNK:
                    yield lot()
                    held, size = [], 0
        if size:
            yield lot()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[bytes]] = [[], [], []]
        for batch in batches:
            for x, name in zip(held, ("context", "next", "n")):
                x.extend(batch.column(name).to_pylist())
        context, after, n = (np.frombuffer(b"".join(x), dtype=kind) for x, kind in zip(held, (U64, U64, np.uint32)))
        keys = mix(context * (_TWO, _THREE)[depth - 1] + after)
        order = np.argsort(keys)
        keys = keys[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, dtype=np.int64)
        sums = np.add.reduceat(n[order].astype(np.int64), first) if len(first) else np.zeros(0, dtype=np.int64)
        often = np.flatnonzero(sums >= LEAST)
        at = order[first[often]]
        yield pa.RecordBatch.from_arrays([*(pa.array(x.view(np.int64)) for x in (keys[first[often]], context[at], after[at])), pa.array(sums[often])], names=["key", "context", "next", "n"])

    return texts.select("text").mapInArrow(count, "bin int, context binary, next binary, n binary").repartition(parts, "bin").mapInArrow(merge, "key long, context long, next long, n long")


def _hot(pairs: DataFrame, column: str, rows: int) -> DataFrame:
    return pairs.groupBy(column).count().filter(F.col("count") * HOT_SHARE >= rows).select(column)


def states(pairs: DataFrame, totals: DataFrame) -> DataFrame:
    """(context, total, back): the contexts that stay, and log10 of what goes to the parent; ``pairs`` have ``parent``, log10 of its probability."""
    n = F.col("n")
    sums = pairs.groupBy("context").agg(F.sum("n").alias("seen"), F.count(n).alias("kinds"), F.sum(F.pow(F.lit(10.0), "parent")).alias("below"), F.sum(n * (F.log10(n - DISCOUNT) - F.col("parent"))).alias("gain"))
    left = lambda x: F.log10(F.greatest(1 - x, F.lit(1e-12)))
    rows = sums.join(totals, "context").withColumn("back", left((F.col("seen") - DISCOUNT * F.col("kinds")) / F.col("total")) - left(F.col("below")))
    gain = F.col("gain") - F.col("seen") * F.log10("total") + (F.col("total") - F.col("seen")) * F.col("back")
    return rows.filter(gain * float(np.log(10)) >= GAIN * F.col("total")).select("context", "total", "back")


def learn(training: DataFrame, words: DataFrame, tokens: int, bottom: float, documents: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The states of depth 1 (context, total, back), and the tree's values: key, n, what the pair adds, and what it adds as the context of the next token."""
    spark = training.sparkSession
    base = words.select(F.col("word").alias("next"), F.log10((F.col("n") + 0.1) / F.lit(float(bottom))).alias("parent"))
    pairs = scratch.table(pair_counts(training, 1, tokens), "pairs-1")
    scratch.release()
    may = spark.sparkContext.broadcast(bitmap(pairs))
    triples = scratch.table(pair_counts(training, 2, tokens, may), "pairs-2")
    may.destroy()
    scratch.release()

    pairs = scratch.table(salted_join(pairs, base, "next", _hot(pairs, "next", pairs.count()), "inner", "key"), "parents-1")
    start = spark.createDataFrame([(int(START.view(np.int64)), documents)], "context long, total long")
    first = scratch.table(states(pairs, words.select(F.col("word").alias("context"), F.col("n").alias("total")).unionByName(start)), "states-1")
    own = F.log10(F.col("n") - DISCOUNT) - F.log10("total")
    kept = salted_join(pairs, first, "context", _hot(pairs, "context", pairs.count()), "left", "key")
    pairs = scratch.table(kept.select("key", "n", F.coalesce(own, "parent").alias("log"), F.coalesce(own - F.col("parent") - F.col("back"), F.lit(0.0)).alias("adds")), "logs-1")
    for name in ("pairs-1", "parents-1"):
        scratch.drop(name)

    parents = pairs.select(F.col("key").alias("next"), F.col("log").alias("parent"))
    triples = scratch.table(salted_join(triples, parents, "next", _hot(triples, "next", triples.count()), "inner", "key"), "parents-2")
    second = scratch.table(states(triples, pairs.select(F.col("key").alias("context"), F.col("n").alias("total"))), "states-2")
    kept = salted_join(triples, second, "context", _hot(triples, "context", triples.count()), "inner", "key")
    depth_2 = kept.select("key", "n", (own - F.col("parent") - F.col("back")).alias("adds"), F.lit(None).cast("double").alias("back"))
    depth_1 = pairs.join(second.select(F.col("context").alias("key"), "back"), "key", "left").select("key", "n", "adds", "back").filter("adds != 0 OR back IS NOT NULL")
    rank = F.floor(F.log2("n") * 16).cast("int")
    values = scratch.table(depth_1.unionByName(depth_2).withColumn("rank", rank), "values")
    for name in ("logs-1", "pairs-2", "parents-2", "states-2"):
        scratch.drop(name)
    scratch.release()
    return first, values


def most_frequent(values: DataFrame) -> int:
    """The least rank that at most HEAVY_PAIRS values reach."""
    ranks = sorted(((r["rank"], r["count"]) for r in values.groupBy("rank").count().collect()), reverse=True)  # at most 16 * 64 rows
    room, least = HEAVY_PAIRS, ranks[0][0] + 1 if ranks else 0
    for rank, n in ranks:
        room -= n
        if room < 0:
            break
        least = rank
    return least


@dataclass
class Known:
    """Sorted hashes, and where those with each of the leading bits begin."""

    hashes: np.ndarray
    starts: np.ndarray
    shift: int

    @classmethod
    def of(cls, hashes: np.ndarray) -> "Known":
        bits = max(1, len(hashes).bit_length())
        return cls(hashes, np.searchsorted(hashes >> U64(64 - bits), np.arange((1 << bits) + 1).astype(U64)).astype(np.int32), 64 - bits)

    def __len__(self) -> int:
        return len(self.hashes)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in ``keys`` that are known, their places here), in no order."""
        lead = (keys >> U64(self.shift)).astype(np.int64)
        at, end = self.starts[lead], self.starts[lead + 1]
        left = np.flatnonzero(at < end)
        at, end, found = at[left], end[left], [(left[:0], at[:0])]
        while len(left):
            same = self.hashes[at] == keys[left]
            found.append((left[same], at[same]))
            go = ~same & (at + 1 < end)
            left, at, end = left[go], at[go] + 1, end[go]
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


@dataclass
class Tree:
    """What is broadcast of the tree: heavy words; per depth, states (sorted contexts, log10 of what goes to the parent) and pairs (sorted keys, what they add)."""

    words: np.ndarray
    base: np.ndarray
    known: np.ndarray  # whether training has it
    states: list[Known]
    backoff: list[np.ndarray]
    keys: Known
    adds: np.ndarray
    heavy: Known


def grow(words: np.ndarray, base: np.ndarray, known: np.ndarray, first: pa.Table, values: pa.Table) -> Tree:
    """The tree of heavy words with log10 base probabilities, their states and the most frequent values."""
    context, back = first["context"].to_numpy().view(U64), first["back"].to_numpy()
    key, adds, further = values["key"].to_numpy().view(U64), values["adds"].to_numpy(), values["back"].to_numpy()
    order, turn = np.argsort(context), np.argsort(key)
    state = turn[~np.isnan(further[turn])]
    return Tree(words, base, known, [Known.of(context[order]), Known.of(key[state])], [back[order], further[state]], Known.of(key[turn]), adds[turn], Known.of(words))


def walk(tree: Tree, t: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per token: log10 base probability (0 unless heavy), whether heavy, whether heavy and known, and what the tree adds to the base."""
    base, heavy = np.zeros(len(t.hashes)), np.zeros(len(t.hashes), dtype=bool)
    hit, at = tree.heavy.find(t.hashes)
    base[hit], heavy[hit] = tree.base[at], True
    seen = np.zeros(len(t.hashes), dtype=bool)
    seen[hit] = tree.known[at]
    more = np.zeros(len(t.hashes))
    for known, adds, keys in (*zip(tree.states, tree.backoff, (t.one, t.two)), *((tree.keys, tree.adds, k) for k in pair_keys(t))):
        hit, at = known.find(keys)
        more[hit] += adds[at]
    return base, heavy, seen, more


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "suffix-tree")
    texts = id_and_text(docs, id_col, text_col).withColumn("held_out", remainder("doc_id", HELD_MODULUS) == HELD)
    training = texts.filter("NOT held_out")
    words = scratch.table(unigrams(texts), "unigrams")
    size = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count_if(F.col("n") > 0).alias("v"), F.coalesce(F.sum("seen"), F.lit(0)).alias("seen")).first()
    total, distinct = int(size["n"]), int(size["v"])
    bottom = total + 0.1 * (distinct + 1)
    is_heavy = (F.col("seen") >= HEAVY * size["seen"]) & (F.col("seen") >= 2)  # at most 1/HEAVY words
    heavy = words.filter(is_heavy).toArrow()
    known, counts = heavy["word"].to_numpy().view(U64), heavy["n"].to_numpy()
    order = np.argsort(known)
    known, counts = known[order], counts[order]
    documents = int(training.count())
    first, values = learn(training, words.filter("n > 0").select("word", "n"), total, bottom, documents, scratch)
    least = most_frequent(values)
    light = words.filter(~is_heavy & (F.col("n") > 0)).select("word", "n").join(first.select(F.col("context").alias("word"), "back"), "word", "left")
    start = int(START.view(np.int64))
    top = first.join(words.filter(is_heavy).select(F.col("word").alias("context")), "context", "left_semi").unionByName(first.filter(F.col("context") == start)).toArrow()  # heavy words and the start
    tree = grow(known, np.log10((counts + 0.1) / bottom), counts > 0, top, values.filter(F.col("rank") >= least).toArrow())  # at most HEAVY_PAIRS rows
    fewer = values.filter(F.col("rank") < least)
    context = spark.sparkContext
    shared, may = context.broadcast(tree), context.broadcast(bitmap(fewer))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, bits, uid = shared.value, may.value, TaskContext.get().partitionId() << 40
        for batch in batches:
            for first, last, data, offsets in text_slices(batch):
                t = tokens_of(data, offsets)
                base, heavy, seen, more = walk(tree, t)
                sums = [np.add.reduceat(x, t.ptr[:-1]) for x in (base, more, seen.astype(np.int64))]
                one, two = pair_keys(t)
                pairs = np.ravel(np.column_stack([one, two]))
                ask = np.flatnonzero(contains(bits, pairs))
                known, _ = tree.keys.find(pairs[ask])
                ask = np.delete(ask, known)

                def lists(at: np.ndarray, keys: np.ndarray) -> pa.Array:
                    cuts = np.searchsorted(at, t.ptr)
                    return pa.ListArray.from_arrays(pa.array(cuts, type=pa.int32()), pa.array(keys.view(np.int64)))

                rare = np.flatnonzero(~heavy)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, last - first), batch.column("held_out").slice(first, last - first), pa.array(uid + np.arange(last - first)), pa.array(np.diff(t.ptr)), pa.array(sums[2]), pa.array(sums[0]), pa.array(sums[1]), lists(rare, t.hashes[rare]), lists(ask // 2, pairs[ask])],
                    names=["doc_id", "held_out", "uid", "n_tokens", "n_heavy", "base", "more", "rare", "pairs"],
                )
                uid += last - first

    rows = scratch.table(texts.mapInArrow(scored, "doc_id long, held_out boolean, uid long, n_tokens long, n_heavy long, base double, more double, rare array<long>, pairs array<long>"), "rows")
    shared.destroy()
    may.destroy()
    zero = F.lit(0)
    of_words = rows.select("uid", F.explode("rare").alias("word")).join(light, "word", "left")
    tail = scratch.table(of_words.groupBy("uid").agg(F.sum(F.log10((F.coalesce("n", zero) + 0.1) / F.lit(float(bottom)))).alias("tail"), F.count("n").alias("tail_known"), F.sum("back").alias("extra")), "of-words")
    scratch.release()
    of_pairs = rows.select("uid", F.explode("pairs").alias("key")).join(fewer.select("key", (F.col("adds") + F.coalesce("back", F.lit(0.0))).alias("adds")), "key")
    tails = tail.join(scratch.table(of_pairs.groupBy("uid").agg(F.sum("adds").alias("adds")), "of-pairs"), "uid", "full")
    scratch.release()
    out = rows.drop("rare", "pairs").join(tails, "uid", "left")
    base_score = F.col("base") + F.coalesce("tail", zero)
    return scratch.finish(out.select("doc_id", "held_out", "n_tokens", (F.col("n_heavy") + F.coalesce("tail_known", zero)).cast("long").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), base_score.alias("base_score"), (base_score + F.col("more") + F.coalesce("extra", zero) + F.coalesce("adds", zero)).alias("score")))
