"""Training-order materialisation: token sequences in the order of a keyed permutation, in fixed-stride binary shards.

A document's ids (closed by id 0) are cut into sequences of ``length`` tokens. The texts are tokenised once: their ids go to
compressed files in the shared folder, and a narrow row a document says where they are and how many sequences they give. Those rows are
numbered in the order of (id, text hash), whatever files the corpus lies in, so sequences have the numbers 0..n-1. A keyed Feistel
network with cycle-walking permutes them, and the value is the sequence's global slot. Slots lie in blocks of ``block`` and shards of
so many blocks that there are ``MOST_SHARDS`` at most. Sequences of one file and block travel together, compressed; a shard's task takes its blocks in order, one at a
time in memory, and writes fixed-stride little-endian unsigned 16-bit records (zero filled), first under another name, then renamed,
so a task that runs again replaces what it wrote. Slot s is record ``s % per_shard`` of shard ``s // per_shard``.

Defined results: null text is empty and gives one sequence of the closing id; repeated rows have sequences of their own; no rows
write no shards; an id of 65,536 or more fails the job, as the records can't hold it.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cadenza.llm.common import Scratch, id_and_text
from cadenza.llm.packing import END
from cadenza.llm.tokens import Encoder, default_path
from cadenza.llm.words import U64, mix

LENGTH = 512
BLOCK = 8192
MOST_SHARDS = 100_000
#: Tasks that read the files of ids.
MOST_TASKS = 100_000
#: Ids of so many bytes make a file.
LOT_BYTES = 16 << 20
#: Documents that one task numbers.
RANGE = 1_000_000
ROUNDS = 6


class Feistel:
    """A keyed permutation of 0..n-1."""

    def __init__(self, n: int, key: int):
        self.n, self.key = n, key
        self.half = max(1, ((max(n - 1, 1)).bit_length() + 1) // 2)

    def _once(self, x: np.ndarray) -> np.ndarray:
        half, low = U64(self.half), U64((1 << self.half) - 1)
        left, right = x >> half, x & low
        for r in range(ROUNDS):
            left, right = right, left ^ (mix(right + U64((self.key * 0x9E3779B97F4A7C15 + r * 0xD1B54A32D192ED03) & ((1 << 64) - 1))) & low)
        return (left << half) | right

    def __call__(self, numbers: np.ndarray) -> np.ndarray:
        out = self._once(numbers.astype(U64))
        while len(walk := np.flatnonzero(out >= U64(self.n))):
            out[walk] = self._once(out[walk])
        return out.astype(np.int64)


def _small(ids: bytes) -> np.ndarray:
    wide = np.frombuffer(ids, dtype="<u4")
    if len(wide) and wide.max() >= 1 << 16:
        raise ValueError(f"id {wide.max()} doesn't fit a record of 16-bit ids")
    return wide.astype("<u2")


def tokenised(docs: DataFrame, folder: str, length: int, tokenizer: str) -> DataFrame:
    """Writes the documents' ids to files below ``folder``; per document: doc_id, tie, file, nth (place in the file), n_tokens, crcs (of its sequences)."""
    arrow = pa.schema([("doc_id", pa.int64()), ("tie", pa.int64()), ("file", pa.string()), ("nth", pa.int32()), ("n_tokens", pa.int64()), ("crcs", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, where = Encoder.of(tokenizer), fs.FileSystem.from_uri(folder)
        where[0].create_dir(where[1])
        squeeze = zstandard.ZstdCompressor(level=6)
        rows: list[tuple] = []
        ids: list[np.ndarray] = []

        def lot() -> pa.RecordBatch:
            name = f"{TaskContext.get().partitionId():08d}-{uuid.uuid4().hex}"
            with where[0].open_output_stream(f"{where[1]}/{name}") as out:
                out.write(squeeze.compress(np.concatenate(ids).tobytes()))
            doc, tie, n, crcs = zip(*rows)
            return pa.RecordBatch.from_arrays([pa.array(doc, type=pa.int64()), pa.array(tie), pa.array([name] * len(rows)), pa.array(np.arange(len(rows), dtype=np.int32)), pa.array(n), pa.array(crcs, type=pa.list_(pa.int64()))], schema=arrow)

        size = 0
        for batch in batches:
            for doc, tie, wide in zip(batch.column("doc_id").to_pylist(), batch.column("tie").to_pylist(), encoder.batch(batch.column("text"))):
                wide += END
                ids.append(_small(wide))
                rows.append((doc, tie, len(ids[-1]), [zlib.crc32(wide[i : i + 4 * length]) for i in range(0, len(wide), 4 * length)]))
                size += len(wide) // 2
                if size >= LOT_BYTES:
                    yield lot()
                    rows, ids, size = [], [], 0
        if rows:
            yield lot()

    return docs.withColumn("tie", F.xxhash64("text")).select("doc_id", "tie", "text").mapInArrow(run, "doc_id long, tie long, file string, nth int, n_tokens long, crcs array<long>")


def numbered(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """``rows`` with ``first``, the number of a document's first sequence, in the order of id and tie: ranges are sorted apart, and one row a range says where it begins."""
    parts = max(1, -(-rows.count() // RANGE))
    order = ["doc_id", "tie", "file", "nth"]
    stored = scratch.table(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()), "ranges").withColumn("_range", F.shiftright("_id", 33))
    pieces = F.size("crcs").cast("long")
    sizes = stored.groupBy("_range").agg(F.sum(pieces).alias("_n"))
    bases = sizes.select("_range", F.coalesce(F.sum("_n").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    before = F.coalesce(F.sum(pieces).over(W.partitionBy("_range").orderBy("_id").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return stored.withColumn("_before", before).join(F.broadcast(bases), "_range").select("doc_id", "file", "nth", "n_tokens", "crcs", (F.col("_base") + F.col("_before")).alias("first"))


def materialise(docs: DataFrame, path: str, key: int = 20, length: int = LENGTH, block: int = BLOCK, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes ``shard-*.bin`` below ``path`` (a folder all executors share) and returns the manifest, one row per sequence:
    doc_id, piece, n_tokens, ids_crc32, slot, shard, position."""
    scratch = Scratch(docs.sparkSession, "ordering")
    folder = scratch.dir("ids")
    stored = scratch.table(tokenised(id_and_text(docs, id_col, text_col), folder, length, tokenizer or default_path()), "tokenised")
    rows = scratch.table(numbered(stored, scratch), "numbered")
    scratch.drop("tokenised")
    scratch.drop("ranges")
    total, files = rows.agg(F.coalesce(F.sum(F.size("crcs").cast("long")), F.lit(0)), F.count_distinct("file")).first()
    blocks = -(-total // block)
    per_shard = block * max(1, -(-blocks // MOST_SHARDS))
    order = Feistel(total, key)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, squeeze, loose = fs.FileSystem.from_uri(folder), zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()
        for batch in batches:
            for name, listed in zip(batch.column("file").to_pylist(), batch.column("listed")):
                with where[0].open_input_stream(f"{where[1]}/{name}") as f:
                    ids = np.frombuffer(loose.decompress(f.read()), dtype="<u2")
                n, first = (listed.values.field(c).to_numpy() for c in ("n_tokens", "first"))
                pieces = -(-n // length)
                doc = np.repeat(np.arange(len(n)), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = (np.cumsum(n) - n)[doc] + piece * length
                size = np.minimum(length, n[doc] - piece * length)
                slots = order(first[doc] + piece)
                turn = np.argsort(slots)
                cuts = np.flatnonzero(np.diff(slots[turn] // block)) + 1
                out = []
                for own in np.split(turn, cuts):
                    held = np.zeros((len(own), length), dtype="<u2")
                    for i, k in enumerate(own.tolist()):
                        held[i, : size[k]] = ids[start[k] : start[k] + size[k]]
                    at = int(slots[own[0]])
                    out.append((at // per_shard, at // block, slots[own].astype("<i8").tobytes(), squeeze.compress(held.tobytes())))
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))], names=["shard", "block", "slots", "ids"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, where, loose = TaskContext.get().partitionId(), fs.FileSystem.from_uri(path), zstandard.ZstdDecompressor()
        out, names, now, n = None, None, -1, 0
        held = np.zeros((0, length), dtype="<u2")
        filled = np.zeros(0, dtype=bool)

        def flush() -> None:
            if not filled.all():
                raise ValueError(f"block {now} has slots without a sequence")
            out.write(held.tobytes())

        for batch in batches:
            for at, slots, raw in zip(batch.column("block").to_pylist(), batch.column("slots").to_pylist(), batch.column("ids").to_pylist()):
                if out is None:
                    where[0].create_dir(where[1])
                    names = [f"{where[1]}/_{part:08d}-{TaskContext.get().taskAttemptId()}", f"{where[1]}/shard-{part:08d}.bin"]
                    out = where[0].open_output_stream(names[0])
                if at != now:
                    if now >= 0:
                        flush()
                    now, rows_here = at, min(block, total - at * block)
                    held, filled = np.zeros((rows_here, length), dtype="<u2"), np.zeros(rows_here, dtype=bool)
                    n += rows_here
                place = np.frombuffer(slots, dtype="<i8") - at * block
                held[place] = np.frombuffer(loose.decompress(raw), dtype="<u2").reshape(-1, length)
                filled[place] = True
        if out is not None:
            flush()
            out.close()
            where[0].move(*names)
            yield pa.RecordBatch.from_pydict({"shard": pa.array([part], type=pa.int32()), "n": pa.array([n], type=pa.int64())})

    if total:
        listed = rows.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("nth", "n_tokens", "first"))).alias("listed")).repartition(min(files, MOST_TASKS))
        parts = -(-total // per_shard)
        dealt = listed.mapInArrow(cut, "shard int, block long, slots binary, ids binary").repartitionById(parts, "shard").sortWithinPartitions("block")
        done = scratch.table(dealt.select("block", "slots", "ids").mapInArrow(write, "shard int, n long"), "shards")
        if done.agg(F.sum("n")).first()[0] != total:
            raise ValueError("shards without all their sequences")
    scratch.drop("ids")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = order(batch.column("number").to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(slots), pa.array((slots // per_shard).astype(np.int32)), pa.array(slots % per_shard)], names=["doc_id", "piece", "n_tokens", "ids_crc32", "slot", "shard", "position"])

    each = rows.select("doc_id", "n_tokens", "first", F.posexplode("crcs").alias("piece", "ids_crc32"))
    each = each.select("doc_id", "piece", F.least(F.lit(length), F.col("n_tokens") - F.col("piece") * length).cast("int").alias("n_tokens"), "ids_crc32", (F.col("first") + F.col("piece")).alias("number"))
    return scratch.finish(each.mapInArrow(place, "doc_id long, piece int, n_tokens int, ids_crc32 long, slot long, shard int, position long"))


class Reader:
    """Sequences of a folder of shards by slot; the shards' sizes say which slots they hold."""

    def __init__(self, path: str, length: int = LENGTH):
        self.length = length
        self.system, folder = fs.FileSystem.from_uri(path)
        found = sorted((f for f in self.system.get_file_info(fs.FileSelector(folder)) if f.base_name.startswith("shard-")), key=lambda f: f.base_name)
        self.names = [f.path for f in found]
        self.firsts = np.concatenate([[0], np.cumsum([f.size // (2 * length) for f in found])]).astype(np.int64)

    def __len__(self) -> int:
        return int(self.firsts[-1])

    def read(self, start: int, n: int) -> np.ndarray:
        """The sequences of slots start..start+n-1 (as far as there are any), zero filled; any slot can be the first."""
        out = []
        end = min(start + n, len(self))
        while start < end:
            i = int(np.searchsorted(self.firsts, start, side="right")) - 1
            take = min(end, int(self.firsts[i + 1])) - start
            with self.system.open_input_file(self.names[i]) as f:
                f.seek((start - int(self.firsts[i])) * 2 * self.length)
                out.append(np.frombuffer(f.read(take * 2 * self.length), dtype="<u2").reshape(-1, self.length))
            start += take
        return np.concatenate(out) if out else np.zeros((0, self.length), dtype="<u2")
