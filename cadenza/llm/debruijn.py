"""Repeated substrings of words by De Bruijn compaction in minimizer space.

Nodes are the token k-mers that are the least (by hash) of some ``SPAN - K + 1`` consecutive ones, so every window of ``SPAN`` words
has at least one and equal windows have the same. An edge runs from a node's occurrence to the document's next and is named
by the words from the one's first to the other's last. A node that occurs more than once, always between the same two edges, doesn't
branch; runs of such nodes are compacted by Spark joins (pointer doubling towards the first node of the path). A document has a path
whole or not at all, so only a path's first node and its length are sent to the documents.

There a path and its two outer edges are one long span of words. It is verified at its source coordinates: spans of a path are grouped
by 128 bits of all their words, and each must be there at least twice. A path with a span that is alone (nodes or edges of equal hash but other words) is given up,
and its nodes count as branching. Verified spans are removed whole. All other windows of repeated nodes, and a span's first and last (their node may be
an outer one, which also occurs without the path), are verified one by one at their coordinates: they are counted by 128-bit hashes of their words. A window of a node that occurs once is not repeated.

Defined results: null text has no words; documents of fewer words than a window lose nothing; repeated rows are
documents that repeat each other; a null id is kept as it is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import HOT_SHARE, Scratch, id_and_text, salted_join, with_rows
from cadenza.llm.words import AS_IS, NOT_SPACE, U64, Powers, Words, sliding, split, text_slices

SPAN, K = 35, 12
_FIRST, _SECOND = Powers(0xD1342543DE82EF95), Powers(0xAF251AF3B0F025B5)


@dataclass
class Nodes:
    """Of some documents: word hashes' running sums, the windows' least k-mer hash, and the nodes."""

    words: Words
    sums: np.ndarray
    hashes: np.ndarray  # of the k-mer at each word
    least: np.ndarray  # of each window's k-mers; 0 where no window begins
    at: np.ndarray  # word positions of nodes
    doc: np.ndarray  # their documents


def nodes_of(data: np.ndarray, offsets: np.ndarray) -> Nodes:
    words = split(data, offsets, NOT_SPACE, AS_IS)
    sums = _FIRST.sums(words.hashes())
    n = len(words.starts)
    hashes = _FIRST.windows(sums, K) | U64(1)
    wide = SPAN - K + 1
    least = sliding(hashes, wide) if len(hashes) >= wide else hashes[:0]
    ends = np.repeat(words.ptr[1:], np.diff(words.ptr))
    least = np.where(np.arange(len(least)) + SPAN <= ends[: len(least)], least, U64(0))
    reach = np.concatenate([np.zeros(wide - 1, dtype=U64), least, np.zeros(wide - 1, dtype=U64)])
    most = sliding(reach, wide, np.maximum)[: len(hashes)] if len(least) else np.zeros(len(hashes), dtype=U64)
    at = np.flatnonzero((most == hashes[: len(most)]) & (most > 0)) if n else np.zeros(0, dtype=np.int64)
    return Nodes(words, sums, hashes, least, at, np.searchsorted(words.ptr, at, side="right") - 1)


def joined_sha(words: Words, doc: int, removed: np.ndarray | None = None) -> str:
    """sha256 of a document's words, or those not removed, joined by one space."""
    a, b = int(words.ptr[doc]), int(words.ptr[doc + 1])
    raw = words.data[words.starts[a] : words.starts[b - 1] + words.lens[b - 1]].tobytes().split() if b > a else []
    if removed is not None:
        raw = [w for w, gone in zip(raw, removed.tolist()) if not gone]
    return hashlib.sha256(b" ".join(raw)).hexdigest()


def occurrences(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, row, n_words, sha, and its nodes' positions, hashes and edges to the next (0: none)."""
    schema = "doc_id long, row long, n_words long, sha string, at array<int>, node array<long>, edge array<long>"
    arrow = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("n_words", pa.int64()), ("sha", pa.string()), ("at", pa.list_(pa.int32())), ("node", pa.list_(pa.int64())), ("edge", pa.list_(pa.int64()))])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_slices(batch):
                x = nodes_of(data, offsets)
                cuts = pa.array(np.searchsorted(x.doc, np.arange(last - first + 1)), type=pa.int32())
                edge = np.zeros(len(x.at), dtype=U64)
                if len(x.at) > 1:
                    same = x.doc[1:] == x.doc[:-1]
                    edge[:-1] = np.where(same, _FIRST.spans(x.sums, x.at[:-1], np.minimum(x.at[1:] + K, len(x.sums) - 1)) | U64(1), U64(0))
                lists = [pa.ListArray.from_arrays(cuts, pa.array(v)) for v in ((x.at - x.words.ptr[x.doc]).astype(np.int32), x.hashes[x.at].view(np.int64), edge.view(np.int64))]
                sha = [joined_sha(x.words, i) for i in range(last - first)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, last - first), batch.column("row").slice(first, last - first), pa.array(np.diff(x.words.ptr)), pa.array(sha), *lists], schema=arrow)

    return docs.mapInArrow(found, schema)


def compacted(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, path, step): the nodes that don't branch, by path (its first node) and their place in it.

    Each round a node that hasn't reached the first takes over the pointer of the node it points to, so a path of n nodes
    takes log2(n) rounds of one join each; rounds are written.
    """
    inner = nodes.filter("inner")
    steps = inner.alias("x").join(inner.select(F.col("node").alias("before")), "before", "left_semi").select("node", "before", F.lit(1).alias("step"))
    heads = inner.join(steps.select("node"), "node", "left_anti").select("node", F.col("node").alias("path"), F.lit(0).alias("step"))
    done, open_, i = scratch.table(heads, "path-0"), scratch.table(steps, "open-0"), 0
    parts = [done]
    while not open_.isEmpty():
        i += 1
        known = parts[0]
        for more in parts[1:]:
            known = known.unionByName(more)
        reached = open_.join(known.select(F.col("node").alias("before"), "path", F.col("step").alias("far")), "before").select("node", "path", (F.col("step") + F.col("far")).alias("step"))
        jump = open_.select(F.col("node").alias("before"), F.col("before").alias("further"), F.col("step").alias("far"))
        still = open_.join(jump, "before").select("node", F.col("further").alias("before"), (F.col("step") + F.col("far")).alias("step"))
        parts.append(scratch.table(reached, f"path-{i}"))
        open_ = scratch.table(still, f"open-{i}")
        scratch.drop(f"open-{i - 1}")
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


SPANS = "array<struct<path:long,start:int,end:int,one:long,two:long>>"
_SPAN = pa.list_(pa.struct([("path", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("one", pa.int64()), ("two", pa.int64())]))


def _windows(texts: DataFrame) -> DataFrame:
    """Per marked document: the spans of its paths, and the windows outside them to verify, both with 128 bits of their words."""
    schema = f"row long, spans {SPANS}, start array<int>, one array<long>, two array<long>"
    arrow = pa.schema([("row", pa.int64()), ("spans", _SPAN), ("start", pa.list_(pa.int32())), ("one", pa.list_(pa.int64())), ("two", pa.list_(pa.int64()))])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, marks = batch.column("row"), batch.column("marks")
            for first, last, data, offsets in text_slices(batch):
                x = nodes_of(data, offsets)
                second = _SECOND.sums(x.words.hashes(seed=9))
                own = marks.slice(first, last - first)
                flat, counts = own.flatten(), np.array([len(m) for m in own], dtype=np.int64)
                length = flat.field("length").to_numpy()
                doc = np.repeat(np.arange(last - first), counts)
                where = np.searchsorted(x.at, flat.field("at").to_numpy() + x.words.ptr[doc])
                repeated = np.zeros(len(x.at), dtype=bool)
                repeated[where] = True

                # a path from its node before the first to its node after the last
                head, size, of = where[length > 0], length[length > 0], doc[length > 0]
                lo, hi = np.maximum(head - 1, 0), np.minimum(head + size, max(len(x.at) - 1, 0))
                whole = (head > 0) & (head + size < len(x.at)) & (x.doc[lo] == of) & (x.doc[hi] == of) if len(head) else np.zeros(0, dtype=bool)
                a, b = x.at[lo], np.where(whole, x.at[hi] + K, x.at[lo]) if len(head) else x.at[lo]
                one, two = (p.spans(sums, a, b).view(np.int64) for p, sums in ((_FIRST, x.sums), (_SECOND, second)))
                # what isn't whole can't be the path: it is alone
                one = np.where(whole, one, np.arange(len(a)) + (rows.slice(first, last - first).to_numpy()[of] << 20))
                base = x.words.ptr[of]
                spans = pa.StructArray.from_arrays([pa.array(v) for v in (x.hashes[x.at[head]].view(np.int64), (a - base).astype(np.int32), (b - base).astype(np.int32), one, two)], fields=list(_SPAN.value_type))
                turns = np.zeros(len(x.at) + 1, dtype=np.int64)
                np.add.at(turns, head[whole], 1)
                np.add.at(turns, hi[whole], -1)
                repeated |= np.cumsum(turns[:-1]) > 0
                # where windows begin that a span holds and that touch neither end of it: their node is one of the path, so wherever
                # they occur the span does. At an end the node may be an outer one, which the path needn't follow (where a text ends)
                covers = np.zeros(len(x.words.starts) + 1, dtype=np.int64)
                long = whole & (b - a > SPAN)
                np.add.at(covers, a[long] + 1, 1)
                np.add.at(covers, b[long] - SPAN, -1)

                # the node of each window: the first of its least k-mers
                s = np.flatnonzero((x.least > 0) & (np.cumsum(covers)[: len(x.least)] == 0))
                j = np.searchsorted(x.at, s)
                node = x.hashes[x.at]
                wrong = np.flatnonzero(node[j] != x.least[s]) if len(s) else s
                while len(wrong):
                    j[wrong] += 1
                    wrong = wrong[node[j[wrong]] != x.least[s[wrong]]]
                s = s[repeated[j]]
                at = np.searchsorted(x.words.ptr, s, side="right") - 1
                edges = np.arange(last - first + 1)
                asked = [(s - x.words.ptr[at]).astype(np.int32), *(p.spans(sums, s, s + SPAN).view(np.int64) for p, sums in ((_FIRST, x.sums), (_SECOND, second)))]
                cuts, span_cuts = (pa.array(np.searchsorted(d, edges), type=pa.int32()) for d in (at, of))
                yield pa.RecordBatch.from_arrays([rows.slice(first, last - first), pa.ListArray.from_arrays(span_cuts, spans).cast(_SPAN), *(pa.ListArray.from_arrays(cuts, pa.array(v)) for v in asked)], schema=arrow)

    return texts.mapInArrow(made, schema)


def _cut(rows: DataFrame) -> DataFrame:
    """row, n_removed, spans and sha of the marked documents, given the spans [start, end) that go."""
    schema = "row long, n_removed long, spans array<struct<start:long,end:long>>, kept string"
    arrow = pa.schema([("row", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.string())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, gone_here = [], batch.column("gone")
            for first, last, data, offsets in text_slices(batch):
                words = split(data, offsets, NOT_SPACE, AS_IS)
                for i in range(last - first):
                    own = gone_here[first + i].values
                    gone = covered(own.field("start").to_numpy(), own.field("end").to_numpy(), int(words.ptr[i + 1] - words.ptr[i]))
                    turns = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                    out.append({"row": batch.column("row")[first + i].as_py(), "n_removed": int(gone.sum()), "spans": [{"start": int(a), "end": int(b)} for a, b in zip(turns[::2], turns[1::2])], "kept": joined_sha(words, i, gone)})
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return rows.mapInArrow(cut, schema)


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n places the spans [start, end) cover."""
    depth = np.zeros(n + 1, dtype=np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, ends, -1)
    return np.cumsum(depth[:-1]) > 0


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, spans (removed word ranges), kept_sha256."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "debruijn")
    texts, apart = with_rows(id_and_text(docs, id_col, text_col))
    found = scratch.table(occurrences(texts), "occurrences")
    each = found.select("row", F.posexplode(F.arrays_zip("at", "node", "edge")).alias("i", "x"), "node", "edge").select(
        "row", "x.at", "x.node", F.when(F.col("i") > 0, F.element_at("edge", F.col("i"))).otherwise(F.lit(0)).cast("long").alias("into"), F.col("x.edge").alias("out"), F.when(F.col("i") > 0, F.element_at("node", F.col("i"))).otherwise(F.lit(0)).cast("long").alias("before")
    )
    counts = each.groupBy("node").agg(F.count(F.lit(1)).alias("n"), *(f(c).alias(f"{c}_{k}") for c in ("into", "out") for k, f in (("least", F.min), ("most", F.max))), F.min("before").alias("before")).filter("n > 1")
    inner = (F.col("into_least") == F.col("into_most")) & (F.col("out_least") == F.col("out_most")) & (F.col("into_least") != 0) & (F.col("out_least") != 0)
    nodes = scratch.table(counts.select("node", "n", "before", inner.alias("inner")), "nodes")
    paths = scratch.table(compacted(nodes, scratch).select("node", "path"), "paths")
    total = found.agg(F.sum(F.size("at"))).first()[0] or 0
    given_up: DataFrame | None = None
    for turn in range(100):
        kept = paths if given_up is None else paths.join(given_up, "path", "left_anti")
        lengths = kept.groupBy(F.col("path").alias("node")).agg(F.count(F.lit(1)).cast("int").alias("length"))
        inside = kept.filter("node <> path").select("node")
        known = scratch.table(nodes.join(inside, "node", "left_anti").join(lengths, "node", "left").select("node", "n", F.coalesce("length", F.lit(0)).alias("length")), f"known-{turn}")
        scratch.release()
        hot = known.filter(F.col("n") * HOT_SHARE >= total).select("node")
        marks = salted_join(each.select("row", "at", "node"), known.select("node", "length"), "node", hot, "inner", "row")
        marks = marks.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("at", "length"))).alias("marks"))
        marked = scratch.table(texts.join(marks, "row"), f"marked-{turn}")
        scratch.release()
        asked = scratch.table(_windows(marked), f"asked-{turn}")
        alone = asked.select(F.explode("spans").alias("x")).select("x.*").groupBy("path", F.expr("end - start").alias("n_words"), "one", "two").agg(F.count(F.lit(1)).alias("n")).filter("n = 1").select("path").distinct()
        alone = scratch.table(alone if given_up is None else alone.unionByName(given_up).distinct(), f"alone-{turn}")
        if alone.count() == (0 if given_up is None else given_up.count()):
            break
        given_up = alone
    else:
        raise RuntimeError("paths did not settle")

    each_window = asked.select("row", F.explode(F.arrays_zip("start", "one", "two")).alias("x")).select("row", "x.start", "x.one", "x.two").withColumn("window", F.struct("one", "two"))
    often = scratch.table(each_window.groupBy("one", "two").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "often").withColumn("window", F.struct("one", "two"))
    scratch.release()
    asked_total = asked.agg(F.sum(F.size("start"))).first()[0] or 0
    hot = often.filter(F.col("n") * HOT_SHARE >= asked_total).select("window")
    verified = salted_join(each_window.select("row", "start", "window"), often.select("window"), "window", hot, "left_semi", "row").groupBy("row").agg(F.collect_set("start").alias("verified"))
    once = (lambda df: df) if apart else (lambda df: df.dropDuplicates(["row"]))
    whole = F.transform(F.filter("spans", lambda s: s["end"] - s["start"] >= SPAN), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    windows = F.transform(F.coalesce("verified", F.array().cast("array<int>")), lambda s: F.struct(s.alias("start"), (s + SPAN).alias("end")))
    gone = once(asked.select("row", "spans")).join(verified, "row", "left").select("row", F.concat(whole, windows).alias("gone")).filter(F.size("gone") > 0)
    changed = _cut(once(marked.select("row", "text")).join(gone, "row"))
    out = found.select("doc_id", "row", "n_words", "sha").join(changed, "row", "left")
    return scratch.finish(out.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("spans", F.expr("CAST(array() AS array<struct<start:long,end:long>>)")).alias("spans"), F.coalesce("kept", "sha").alias("kept_sha256")))
