"""Repeated byte strings by external induced suffix sorting.

Strings of ``SPAN`` bytes that occur more than once are found without sorting the whole corpus at once. The least (by hash) of a
string's ``K``-byte substrings is its node; equal strings have equal nodes, so a string whose node occurs once is not
repeated, and all others can be sorted node by node. The strings of one node's occurrence overlap and form one
segment of at most ``2 * SPAN - K`` bytes. Equal segments are merged, with their number, before their bytes are shuffled; a node that
holds more than its share of segments is split further, by the greatest substring of each string. A node all of whose
segments are equal has nothing to be put in order: its strings are repeated as they stand. Each shard of the other segments is
written to files and its suffixes sorted by induced sorting (``suffixsort``); neighbours in the order that share SPAN bytes are
one string, which is repeated if its segments came up more than once. The removed bytes go back to the documents by segment.

Defined results: null text is empty; documents of fewer bytes lose nothing; repeated rows are documents that repeat each
other; a null id is kept as it is.
"""

from __future__ import annotations

import hashlib
import os
import shutil
import tempfile
import uuid
from collections.abc import Hashable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import HOT_SHARE, Scratch, id_and_text, salted_join, with_rows
from cadenza.llm.suffixsort import LIMIT, Store, sort_suffixes
from cadenza.llm.words import U64, Powers, mix, sliding, text_slices

SPAN, K = 200, 32
WIDE = SPAN - K + 1
SLICE = 1 << 18
#: Segments are dealt to shards of about so many bytes, which are sorted in memory; beyond so many shards they grow, and are sorted on disk.
SHARD_BYTES, MOST_SHARDS = 2 << 20, 50_000
_NAMES = (Powers(0xD1342543DE82EF95), Powers(0xAF251AF3B0F025B5))
_BYTES = mix(np.arange(1, 257, dtype=U64) * U64(0xA0761D6478BD642F))
_PARTS = [U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9), U64(0xD6E8FEB86659FD93)]


@dataclass
class Nodes:
    hashes: np.ndarray  # of the K bytes at each place
    least: np.ndarray  # of each string's substrings; 0 where no string begins
    at: np.ndarray  # places of nodes
    doc: np.ndarray


def nodes_of(data: np.ndarray, offsets: np.ndarray) -> Nodes:
    n = len(data)
    if n < SPAN:
        none = np.zeros(0, dtype=np.int64)
        return Nodes(np.zeros(0, dtype=U64), np.zeros(0, dtype=U64), none, none)
    room = np.zeros(n + 8, dtype=np.uint8)
    room[:n] = data
    eight = np.ndarray((n - 7,), dtype="<u8", buffer=room.data, strides=(1,)) * U64(0xBF58476D1CE4E5B9)
    eight ^= eight >> U64(29)
    m = n - K + 1
    hashes = eight[:m] * _PARTS[0]
    for i, f in enumerate(_PARTS[1:], 1):
        hashes += eight[8 * i : 8 * i + m] * f
    hashes = mix(hashes) | U64(1)
    least = sliding(hashes, WIDE)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        least[max(a, b - SPAN + 1) : b] = 0
    reach = np.concatenate([np.zeros(WIDE - 1, dtype=U64), least, np.zeros(WIDE - 1, dtype=U64)])
    at = np.flatnonzero(sliding(reach, WIDE, np.maximum)[:m] == hashes)
    return Nodes(hashes, least, at, np.searchsorted(offsets, at, side="right") - 1)


def occurrences(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, row, n_bytes, sha, at and node (its nodes' places and hashes)."""
    arrow = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("n_bytes", pa.int64()), ("sha", pa.string()), ("at", pa.list_(pa.int32())), ("node", pa.list_(pa.int64()))])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_slices(batch, limit=SLICE):
                x = nodes_of(data, offsets)
                cuts = pa.array(np.searchsorted(x.doc, np.arange(last - first + 1)), type=pa.int32())
                sha = [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                lists = [pa.ListArray.from_arrays(cuts, pa.array(v)) for v in ((x.at - offsets[x.doc]).astype(np.int32), x.hashes[x.at].view(np.int64))]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, last - first), batch.column("row").slice(first, last - first), pa.array(np.diff(offsets)), pa.array(sha), *lists], schema=arrow)

    return docs.mapInArrow(found, "doc_id long, row long, n_bytes long, sha string, at array<int>, node array<long>")


def _cut_segments(batch: pa.RecordBatch, hot: np.ndarray) -> Iterator[dict[str, np.ndarray]]:
    """Arrays of row (of the batch), start, size, node, sub and the name (128 bits of the bytes) of the segments of a batch's marked nodes, in lots."""
    marks = batch.column("marks")
    for first, last, data, offsets in text_slices(batch, limit=SLICE):
        x = nodes_of(data, offsets)
        marked = np.zeros(len(x.at), dtype=bool)
        own = marks.slice(first, last - first)
        values, lens = own.flatten().to_numpy(), np.array([len(m) for m in own], dtype=np.int64)
        marked[np.searchsorted(x.at, values + np.repeat(offsets[:-1], lens))] = True
        s = np.flatnonzero(x.least > 0)
        if not len(s):
            continue
        node, j = x.hashes[x.at], np.searchsorted(x.at, s)
        wrong = np.flatnonzero(node[j] != x.least[s])
        while len(wrong):
            j[wrong] += 1
            wrong = wrong[node[j[wrong]] != x.least[s[wrong]]]
        ok = marked[j]
        s, j = s[ok], j[ok]
        if not len(s):
            continue
        sub = np.zeros(len(s), dtype=U64)
        if len(hot):
            crowded = np.isin(node[j].view(np.int64), hot)
            if crowded.any():
                sub[crowded] = sliding(x.hashes, WIDE, np.maximum)[s[crowded]]
        turn = np.flatnonzero((j[1:] != j[:-1]) | (sub[1:] != sub[:-1]) | (s[1:] != s[:-1] + 1)) + 1
        head, tail = np.concatenate([[0], turn]), np.concatenate([turn - 1, [len(s) - 1]])
        a, b, of = s[head], s[tail] + SPAN, x.doc[j[head]]
        items = _BYTES[data]
        one, two = (p.spans(p.sums(items), a, b).view(np.int64) for p in _NAMES)
        yield {"row": first + of, "start": (a - offsets[of]).astype(np.int32), "size": (b - a).astype(np.int32), "node": node[j[head]].view(np.int64), "sub": sub[head].view(np.int64), "one": one, "two": two}


def places(marked: DataFrame, hot) -> DataFrame:
    """(row, start, size, node, sub, one, two) of every segment."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("row").to_numpy()
            for lot in _cut_segments(batch, hot.value):
                yield pa.RecordBatch.from_pydict(lot | {"row": rows[lot["row"]]})

    return marked.select("row", "text", "marks").mapInArrow(cut, "row long, start int, size int, node long, sub long, one long, two long")


def _bytes_of(marked: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, sub, one, two, copies, segment) of the segments whose first places ``wanted`` lists by row."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, wants in zip(batch.column("text"), batch.column("wants").to_pylist()):
                raw = text.as_buffer().to_pybytes()
                out += [(w["node"], w["sub"], w["one"], w["two"], w["copies"], raw[w["start"] : w["start"] + w["size"]]) for w in wants]
            columns = zip(*out) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, (*[pa.int64()] * 5, pa.binary()))], names=["node", "sub", "one", "two", "copies", "segment"])

    lists = wanted.groupBy("row").agg(F.collect_list(F.struct("start", "size", "node", "sub", "one", "two", "copies")).alias("wants"))
    return marked.select("row", "text").join(lists, "row").select("text", "wants").mapInArrow(cut, "node long, sub long, one long, two long, copies long, segment binary")


def repeated_in(shard: Iterator[tuple[Hashable, int, bytes]], folder: str, limit: int = LIMIT) -> Iterator[tuple[Hashable, int, bytes | None]]:
    """(name, copies, bits of the repeated strings, None for all) of the segments of a shard, which come by name; segments without any are left out."""
    os.makedirs(folder, exist_ok=True)
    store = Store(folder, limit)
    names, copies, lens = [], [], []
    with open(f"{folder}/bytes", "wb") as f:
        for name, n, raw in shard:
            if names and names[-1] == name:
                copies[-1] += n
                continue
            names.append(name), copies.append(n), lens.append(len(raw))
            f.write(raw + b"\0")
    if not names:
        return
    lens_, weight = np.array(lens, dtype=np.int64), np.array(copies, dtype=np.int64)
    ends = np.cumsum(lens_ + 1) - 1
    first = ends - lens_
    n = int(ends[-1]) + 1
    raw = np.memmap(f"{folder}/bytes", dtype=np.uint8, mode="r", shape=(n,))
    text = store.array(n + 1, np.int16)
    for a in range(0, n, 1 << 22):
        text[a : min(n, a + (1 << 22))] = raw[a : a + (1 << 22)].astype(np.int16) + 2
    text[ends] = 1
    order = sort_suffixes(text, store)
    store.drop(text)
    hit = store.array(n, bool)
    eight = np.ndarray((n - 7,), dtype="<u8", buffer=raw, strides=(1,))
    open_ = np.zeros(0, dtype=np.int64)
    for a in range(0, len(order), 1 << 20):
        places = np.asarray(order[a : a + (1 << 20)])
        at = np.searchsorted(ends, places)
        fits = at < len(ends)
        fits[fits] &= places[fits] + SPAN <= ends[at[fits]]
        places = np.concatenate([open_, places[fits]])
        if not len(places):
            continue
        x, y = places[:-1], places[1:]
        live = np.arange(len(x))
        for k in range(0, SPAN, 8):  # the common prefix of neighbours, as far as SPAN
            live = live[eight[x[live] + k] == eight[y[live] + k]]
        new = np.ones(len(places), dtype=bool)
        new[live + 1] = False
        heads = np.flatnonzero(new)
        w = np.add.reduceat(weight[np.searchsorted(ends, places)], heads)
        many = np.repeat(w > 1, np.diff(np.append(heads, len(places))))
        hit[places[many]] = True
        open_ = places[heads[-1] :]
    for i, (a, b) in enumerate(zip(first.tolist(), ends.tolist())):
        bits = np.asarray(hit[a : b - SPAN + 1])
        if bits.any():
            yield names[i], copies[i], None if bits.all() else np.packbits(bits).tobytes()


def _sorted(found: DataFrame, shards: int, folder: str) -> DataFrame:
    """(one, two, copies, bits) by sorting each shard of segments."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = folder.removeprefix("file://") if folder.startswith(("file:", "/")) else tempfile.mkdtemp(dir=os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None)
        own = f"{base.removeprefix('file:')}/{uuid.uuid4().hex}"
        rows = (((one, two), n, raw) for b in batches for one, two, n, raw in zip(*(b.column(c).to_pylist() for c in ("one", "two", "copies", "segment"))))
        try:
            lot: list[tuple] = []
            for x in repeated_in(rows, own):
                lot.append(x)
                if len(lot) == 20_000:
                    yield _batch(lot)
                    lot = []
            yield _batch(lot)
        finally:
            shutil.rmtree(own, ignore_errors=True)

    dealt = found.repartition(shards, "node", "sub").sortWithinPartitions("one", "two")
    return dealt.select("one", "two", "copies", "segment").mapInArrow(run, "one long, two long, copies long, bits binary")


def _batch(lot: list[tuple]) -> pa.RecordBatch:
    rows = [(*name, n, bits) for name, n, bits in lot]
    columns = zip(*rows) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, (*[pa.int64()] * 3, pa.binary()))], names=["one", "two", "copies", "bits"])


def _cut(rows: DataFrame) -> DataFrame:
    """row, n_removed, spans and kept of documents, given their segments' bits."""
    arrow = pa.schema([("row", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.string())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, hits = [], batch.column("hits")
            flat = hits.flatten()
            starts, sizes = (flat.field(c).to_numpy() for c in ("start", "size"))
            bits = flat.field("bits")
            whole = bits.is_null().to_numpy(zero_copy_only=False)
            cuts = np.concatenate([[0], np.cumsum(np.array([len(h) for h in hits], dtype=np.int64))])
            for i, (row, text) in enumerate(zip(batch.column("row").to_pylist(), batch.column("text"))):
                data = np.frombuffer(text.as_buffer() or b"", dtype=np.uint8)
                own = np.arange(cuts[i], cuts[i + 1])
                full, part = own[whole[own]], own[~whole[own]]
                heads, ends = [starts[full]], [starts[full] + sizes[full]]
                for k in part.tolist():
                    at = starts[k] + np.flatnonzero(np.unpackbits(np.frombuffer(bits[k].as_buffer(), dtype=np.uint8)))
                    heads.append(at)
                    ends.append(at + SPAN)
                depth = np.zeros(len(data) + 1, dtype=np.int64)
                np.add.at(depth, np.concatenate(heads), 1)
                np.add.at(depth, np.concatenate(ends), -1)
                gone = np.cumsum(depth[:-1]) > 0
                turns = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                out.append({"row": row, "n_removed": int(gone.sum()), "spans": [{"start": int(a), "end": int(b)} for a, b in zip(turns[::2], turns[1::2])], "kept": hashlib.sha256(data[~gone]).hexdigest()})
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return rows.mapInArrow(cut, "row long, n_removed long, spans array<struct<start:long,end:long>>, kept string")


def repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, spans (removed byte ranges), kept_sha256."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "suffix-array")
    texts, apart = with_rows(id_and_text(docs, id_col, text_col))
    found = scratch.table(occurrences(texts), "occurrences")
    known_docs = scratch.table(found.select("doc_id", "row", "n_bytes", "sha"), "documents")
    each = found.select("row", F.explode(F.arrays_zip("at", "node")).alias("x")).select("row", "x.at", "x.node")
    known = scratch.table(each.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "known")
    total = found.agg(F.sum(F.size("at"))).first()[0] or 0
    crowded = known.filter(F.col("n") * HOT_SHARE >= total).select("node")
    hot = spark.sparkContext.broadcast(crowded.toArrow().to_pandas()["node"].to_numpy(dtype=np.int64))  # HOT_SHARE rows at most
    scratch.release()
    marks = salted_join(each, known.select("node"), "node", crowded, "left_semi", "row").groupBy("row").agg(F.array_sort(F.collect_set("at")).alias("marks"))
    marked = scratch.table(texts.join(marks, "row").select("row", "text", "marks"), "marked")
    scratch.drop("occurrences")
    scratch.release()
    listed = scratch.table(places(marked, hot), "places")
    names = scratch.table(listed.groupBy("node", "sub", "one", "two").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("row", "start")).alias("at"), F.first("size").alias("size")), "all-names")
    kinds = names.groupBy("node", "sub").agg(F.count(F.lit(1)).alias("kinds"), F.sum("copies").alias("all")).filter("all > 1")
    names = scratch.table(names.join(kinds, ["node", "sub"]), "names")
    scratch.drop("all-names")
    scratch.release()
    alone = names.filter("kinds = 1").select("one", "two", "copies", F.lit(None).cast("binary").alias("bits"))
    once = marked if apart else marked.dropDuplicates(["row"])
    wanted = names.filter("kinds > 1").select("at.row", "at.start", "size", "node", "sub", "one", "two", "copies")
    shards = shards or min(MOST_SHARDS, 1 + (wanted.agg(F.sum("size")).first()[0] or 0) // SHARD_BYTES)
    repeats = scratch.table(_sorted(_bytes_of(once, wanted), shards, scratch.dir("sorting")).unionByName(alone), "repeats").withColumn("name", F.struct("one", "two"))
    scratch.release()
    size = repeats.agg(F.sum("copies")).first()[0] or 0
    often = repeats.filter(F.col("copies") * HOT_SHARE >= size).select("name")
    spots = listed.select("row", "start", "size", F.struct("one", "two").alias("name"))
    hits = salted_join(spots, repeats.select("name", "bits"), "name", often, "inner", "row").groupBy("row").agg(F.collect_set(F.struct("start", "size", "bits")).alias("hits"))
    changed = _cut(once.select("row", "text").join(hits, "row"))
    out = known_docs.join(changed, "row", "left")
    spans = F.coalesce("spans", F.expr("CAST(array() AS array<struct<start:long,end:long>>)"))
    return scratch.finish(out.select("doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.size(spans).cast("long").alias("n_spans"), spans.alias("spans"), F.coalesce("kept", "sha").alias("kept_sha256")))
