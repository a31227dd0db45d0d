"""Benchmark decontamination by a generalised suffix automaton.

The items' words build one automaton whose states are the substrings of all items. Each
document's words are streamed through it; the length of the longest match that ends at each word is tracked, and a
length of ``window`` or more marks the last ``window`` words. An item of fewer words is one window of its own. Words
that no run of ``window`` item bigrams surrounds are skipped before, which loses nothing.

The automaton is broadcast, so its items are bounded: ``BLOCK_WORDS`` words build one automaton, and more
items are worked on block by block, each block in a stage of its own that adds to the spans found so far.

Defined results: null text has no words; an empty document is clean; an item without words has no window; rows of one
item_id are one item (a null id is the item ``null``); each input row gives one row, repeated rows too.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.words import ALNUM, LOWER, U64, mix, split, text_slices

WINDOW = 13
BLOCK_WORDS = 1_000_000
_PAIR = U64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    data = np.frombuffer((text or "").encode(), dtype=np.uint8)
    found = split(data, np.array([0, len(data)]), ALNUM, LOWER)
    return [found.word(i) for i in range(len(found.starts))]


class Automaton:
    """A generalised suffix automaton over word ids."""

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        self.names: list[str] = []
        number: dict[str, int] = {}
        texts: list[tuple[int, list[int]]] = []
        for name, words in items:
            if words:
                item = number.setdefault(name, len(number))
                texts.append((item, [self.ids.setdefault(w, len(self.ids)) for w in words]))
                last = 0
                for w in texts[-1][1]:
                    last = self._extend(last, w)
        self.names = list(number)
        self.shortest = min((min(len(t), window) for _, t in texts), default=0)
        self.short: dict[int, list[tuple[int, int]]] = {}
        self.wide: dict[int, set[int]] = {}
        for item, t in texts:
            ends = self._states(t)
            if len(t) < window:
                self.short.setdefault(ends[-1][0], []).append((len(t), item))
            else:
                for state, length in ends:
                    if length >= window:
                        self.wide.setdefault(self._of_length(state, window), set()).add(item)
        self._shorter = self._inherit()
        self._filter(texts)

    def _extend(self, last: int, w: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        if w in nxt[last]:
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else self._clone(last, w, q)
        cur = len(nxt)
        nxt.append({}), link.append(0), length.append(length[last] + 1)
        p = last
        while p != -1 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][w]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, w, q)
        return cur

    def _clone(self, p: int, w: int, q: int) -> int:
        new = len(self.next)
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q]), self.len.append(self.len[p] + 1)
        self.link[q] = new
        while p != -1 and self.next[p].get(w) == q:
            self.next[p][w] = new
            p = self.link[p]
        return new

    def _of_length(self, state: int, n: int) -> int:
        """The state of the last n words of what ``state`` matches."""
        while self.len[self.link[state]] >= n:
            state = self.link[state]
        return state

    def _states(self, words: list[int]) -> list[tuple[int, int]]:
        """State and length of the longest match at each word."""
        out, state, matched = [], 0, 0
        nxt, link, length = self.next, self.link, self.len
        for w in words:
            while state and w not in nxt[state]:
                state = link[state]
                matched = length[state]
            if w in nxt[state]:
                state, matched = nxt[state][w], matched + 1
            out.append((state, matched))
        return out

    def _inherit(self) -> dict[int, int]:
        """For a state, the nearest state up its suffix links at which a short item ends."""
        found: dict[int, int] = {}
        if self.short:
            for state in sorted(range(1, len(self.len)), key=self.len.__getitem__):
                up = self.link[state]
                near = up if up in self.short else found.get(up)
                if near is not None:
                    found[state] = near
        return found

    def _filter(self, texts: list[tuple[int, list[int]]]) -> None:
        """A bitmap of the items' bigrams (or words, if an item has but one)."""
        words = list(self.ids)
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        lens = np.array([len(w) for w in words], dtype=np.int64)
        from cadenza.llm.words import hash_spans

        hashes = hash_spans(data, np.cumsum(lens) - lens, lens)
        grams = [hashes]
        if self.shortest > 1:
            flat = [np.array(t) for _, t in texts]
            grams = [mix(hashes[t[:-1]] * _PAIR + hashes[t[1:]]) for t in flat]
        grams = np.concatenate(grams) if grams else np.zeros(0, dtype=U64)
        self.bits = max(16, int(len(grams) * 64).bit_length())
        self.seen = np.zeros(1 << self.bits, dtype=bool)
        self.seen[(grams >> U64(64 - self.bits)).astype(np.int64)] = True

    def runs(self, hashes: np.ndarray, ptr: np.ndarray) -> list[tuple[int, int]]:
        """Word ranges that a window may lie in."""
        if not self.shortest or not len(hashes):
            return []
        g = min(2, self.shortest)
        grams = mix(hashes[:-1] * _PAIR + hashes[1:]) if g == 2 else hashes
        may = np.zeros(len(hashes) + 2, dtype=bool)
        may[1 : len(grams) + 1] = self.seen[(grams >> U64(64 - self.bits)).astype(np.int64)]
        if g == 2:
            may[ptr[1:]] = False  # the pair that begins at a document's last word
        turns = np.flatnonzero(may[1:] != may[:-1])
        first, last = turns[::2], turns[1::2]
        long = last - first >= self.shortest - g + 1
        cuts = []
        for a, b in zip(first[long].tolist(), (last[long] + g - 1).tolist()):
            inner = ptr[np.searchsorted(ptr, a, side="right") : np.searchsorted(ptr, b, side="left")].tolist()
            edges = [a, *inner, b]
            cuts += zip(edges[:-1], edges[1:])
        return cuts

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Word spans [start, end) that windows cover, and the items they are from."""
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        for i, (state, matched) in enumerate(self._states([self.ids.get(w, -1) for w in words])):
            size = 0
            if matched >= self.window:
                size = self.window
                items |= self.wide[self._of_length(state, self.window)]
            at = state if state in self.short else self._shorter.get(state)
            while at is not None:
                for n, item in self.short[at]:
                    if n <= matched:
                        size = max(size, n)
                        items.add(item)
                at = self._shorter.get(at)
            if size:
                start = i + 1 - size
                if spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                    while spans and spans[-1][1] >= start:
                        start = min(start, spans.pop()[0])
                spans.append((start, i + 1))
        return spans, items


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, limit: int) -> Iterator[Automaton]:
    block, size = [], 0
    rows = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"), F.col(text_col).alias("text"))
    for row in rows.toLocalIterator():
        words = words_of(row["text"])
        if block and size + len(words) > limit:
            yield Automaton(block, window)
            block, size = [], 0
        block.append((row["item"], words))
        size += len(words)
    yield Automaton(block, window)


def find_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", block_words: int = BLOCK_WORDS, carry: Sequence[str] = ()) -> DataFrame:
    """Per row of ``docs``: doc_id, text, carried (a struct of the columns ``carry``), n_words, spans (word ranges that windows cover), items (their ids, sorted as strings)."""
    spark = docs.sparkSession
    carried = F.struct(*[docs[c] for c in carry]) if carry else F.lit(True)
    out = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"), carried.alias("carried")).withColumns({"n_words": F.lit(0).cast("long"), "spans": F.expr("CAST(array() AS array<struct<start:long,end:long>>)"), "items": F.expr("CAST(array() AS array<string>)")})
    for block in _blocks(benchmark, item_col, "text", window, block_words):
        shared = spark.sparkContext.broadcast(block)

        def matched(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            automaton: Automaton = shared.value
            for batch in batches:
                counts = np.zeros(batch.num_rows, dtype=np.int64)
                spans, items = batch.column("spans").to_pylist(), batch.column("items").to_pylist()
                for first, last, data, offsets in text_slices(batch):
                    found = split(data, offsets, ALNUM, LOWER)
                    counts[first:last] = np.diff(found.ptr)
                    for a, b in automaton.runs(found.hashes(), found.ptr):
                        hit, whose = automaton.hits([found.word(i) for i in range(a, b)])
                        if hit:
                            doc = int(np.searchsorted(found.ptr, a, side="right")) - 1
                            base = a - int(found.ptr[doc])
                            spans[first + doc] = merged([*((s["start"], s["end"]) for s in spans[first + doc]), *((base + x, base + y) for x, y in hit)])
                            items[first + doc] = sorted({*items[first + doc], *(automaton.names[i] for i in whose)})
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), batch.column("carried"), pa.array(counts), pa.array(spans, type=batch.column("spans").type), pa.array(items, type=batch.column("items").type)], schema=batch.schema)

        out = out.mapInArrow(matched, out.schema)
    return out


def merged(spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    out: list[dict[str, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], b)
        else:
            out.append({"start": a, "end": b})
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, coverage_inverse: int = 20, **named) -> DataFrame:
    """``find_matches`` with n_hit, n_items and contaminated: at least 1/coverage_inverse of the words are hit."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    found = find_matches(docs, benchmark, **named).withColumn("n_hit", n_hit).withColumn("n_items", F.size("items").cast("long"))
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (coverage_inverse * F.col("n_hit") >= F.col("n_words")))


def cut_spans(matches: DataFrame, longest: int) -> DataFrame:
    """``matches`` with ``clean_text``: the text without the spans of at least ``longest`` words, from a span's first word to its last."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                raw = text.encode()
                data = np.frombuffer(raw, dtype=np.uint8)
                found, kept, at = split(data, np.array([0, len(data)]), ALNUM, LOWER), [], 0
                for s in spans:
                    if s["end"] - s["start"] >= longest:
                        kept.append(raw[at : found.starts[s["start"]]])
                        at = int(found.starts[s["end"] - 1] + found.lens[s["end"] - 1])
                texts.append((b"".join(kept) + raw[at:]).decode())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts)], names=[*batch.schema.names, "clean_text"])

    return matches.mapInArrow(cut, matches.withColumn("clean_text", F.lit("")).schema)
