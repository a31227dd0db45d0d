"""Best-fit packing by exact-complement hashing.

Documents become token pieces; only their histogram of lengths (at most ``capacity`` counts) reaches the driver.
There, from the longest length down, the gap that a length leaves is looked up in an index of single lengths,
pair sums and triple sums (``Sums``), and a combination that fills it exactly is consumed as often as its
scarcest length allows. Where nothing fills the gap, the best-fitting length goes in and the rest of the gap is looked up again. The plan is
a list of rank ranges per length; each piece finds its place by its rank among the pieces of its length, and ranks come from
per-partition counts, so no length's pieces ever meet in one task.

Defined results: null text is empty and is one piece of the closing id alone; repeated rows are packed one by one; no
rows give no sequences.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cadenza.llm.common import Scratch, id_and_text
from cadenza.llm.tokens import Encoder, default_path

CAPACITY = 2048
END = b"\0\0\0\0"


def pieces(docs: DataFrame, capacity: int, tokenizer: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, and the place for ranks: part and nth of this length in it."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = Encoder.of(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            out: list[tuple] = []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encoder.batch(batch.column("text"))):
                ids += END
                for i, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    n = len(own) // 4
                    out.append((doc, i, at // 4, n, zlib.crc32(own), part, int(seen[n])))
                    seen[n] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()))], names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]) if out else pa.RecordBatch.from_pylist([], schema=pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("part", pa.int32()), ("nth", pa.int64())]))

    return docs.mapInArrow(cut, schema)


class Sums:
    """An index of the single, pair and triple sums of the lengths that are still available.

    For each sum it lists the combinations, the largest part last. Counts only fall, so one that isn't available any more never
    will be again and leaves its list when it comes up: a look-up takes the last of a list, and all look-ups together pass each entry once.
    Triples are listed under their sum by one part; the other two are a pair of the rest.
    """

    def __init__(self, counts: np.ndarray):
        self.left = counts.astype(np.int64).tolist()
        self.some = np.flatnonzero(counts[1:]) + 1
        self.longest = self.some.tolist()
        self.pairs: dict[int, list[int]] = {}
        self.triples: dict[int, list[int]] = {}

    def _pairs_of(self, total: int) -> list[int]:
        """The larger parts of the pairs of this sum, ascending."""
        if total not in self.pairs:
            large = self.some[(self.some >= (total + 1) // 2) & (self.some < total)]
            self.pairs[total] = large[np.isin(total - large, self.some)].tolist()
        return self.pairs[total]

    def _has(self, *parts: int) -> bool:
        return all(self.left[p] >= parts.count(p) for p in parts)

    def pair(self, total: int, beside: int = 0) -> tuple[int, ...] | None:
        """Two lengths of this sum, available ``beside`` another, the larger as large as can be."""
        if total < 2:
            return None
        found = self._pairs_of(total)
        while found and not self._has(found[-1], total - found[-1]):
            found.pop()
        for a in reversed(found):
            if self._has(a, total - a, *([beside] if beside else [])):
                return a, total - a
            if not beside:
                return None
        return None

    def triple(self, total: int) -> tuple[int, ...] | None:
        if total < 3:
            return None
        found = self.triples.setdefault(total, self.some[self.some <= total - 2].tolist())
        while found:
            a = found[-1]
            two = self.pair(total - a, a) if self.left[a] else None
            if two:
                return (a, *two)
            found.pop()
        return None

    def exact(self, gap: int) -> tuple[int, ...] | None:
        """One, two or three lengths whose sum is ``gap``."""
        return (gap,) if self.left[gap] else self.pair(gap) or self.triple(gap)

    def best(self, gap: int) -> int:
        """The longest available length that fits, or 0."""
        for at in range(bisect_right(self.longest, gap) - 1, -1, -1):
            if self.left[self.longest[at]]:
                return self.longest[at]
        return 0

    def take(self, parts: list[int]) -> int:
        """Uses up as many of this combination as its scarcest length allows."""
        kinds = {p: parts.count(p) for p in parts}
        times = min(self.left[p] // n for p, n in kinds.items())
        for p, n in kinds.items():
            self.left[p] -= times * n
        return times


def plan(counts: np.ndarray, capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """(how many sequences, the lengths in each) for ``counts[length]`` pieces."""
    sums, out = Sums(counts), []
    for length in range(capacity, 0, -1):
        while sums.left[length]:
            sums.left[length] -= 1
            content, gap = [length], capacity - length
            while gap:
                more = sums.exact(gap) or ((b,) if (b := sums.best(gap)) else None)
                if not more:
                    break
                for n in more:
                    sums.left[n] -= 1
                content += more
                gap -= sum(more)
            for n in content:
                sums.left[n] += 1
            out.append((sums.take(content), tuple(content)))
    return out


def ranges(planned: list[tuple[int, tuple[int, ...]]], capacity: int) -> tuple[np.ndarray, ...]:
    """Sorted keys (length and first rank), with the first sequence and the offset of each rank range."""
    used, rows, sequence = np.zeros(capacity + 1, dtype=np.int64), [], 0
    for times, content in planned:
        offset = 0
        for n in content:
            rows.append(((n << 44) | int(used[n]), sequence, offset))
            used[n] += times
            offset += n
        sequence += times
    rows.sort()
    return tuple(np.array(c, dtype=np.int64) for c in zip(*rows)) if rows else (np.zeros(0, dtype=np.int64),) * 3


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    cut = scratch.table(pieces(id_and_text(docs, id_col, text_col), capacity, tokenizer or default_path()), "pieces")
    sizes = scratch.table(cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "sizes")
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect():  # capacity rows at most
        counts[row["length"]] = row["n"]
    shared = spark.sparkContext.broadcast(ranges(plan(counts, capacity), capacity))
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = sizes.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = cut.join(bases, ["length", "part"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sequences, offsets = shared.value
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.searchsorted(keys, (length << 44) | rank, side="right") - 1
            first = keys[at] & ((1 << 44) - 1) if len(at) else at
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequences[at] + rank - first, type=pa.int64()), pa.array(offsets[at], type=pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    out = scratch.finish(ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"))
    shared.destroy()
    return out
