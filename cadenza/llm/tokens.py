"""Token ids of whole texts by a public tokenizer, with a bounded cache over white-space chunks.

The tokenizer drops white space and never joins characters across it, so a text's ids are the ids of its chunks
in turn. Most chunks repeat; only those that a worker hasn't seen go to the tokenizer, many at a time in one text, which
is cut again where words end, or at a chunk set between them. Chunks are found in the cache by arrays, many at once; they are told apart by
64 bits of hash beside their length and first eight bytes.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa

from cadenza.llm.words import KEPT, NOT_SPACE, U64, give_back, split

CACHE = 1_000_000
SLICE_BYTES = 2 << 20
LOT = 500
MARK = "\x01"
CLOSERS = frozenset(".,!?;:|")
_LEADING = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=U64)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Little-endian unsigned 32-bit ids of texts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self._clear()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends = None
        if suffix:
            self.ends = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), dtype=bool)
            self.ends[[i for w, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if w.endswith(suffix)]] = True

    @classmethod
    def of(cls, path: str) -> "Encoder":
        """This process's encoder for ``path``."""
        if path not in KEPT:
            KEPT[path] = cls(path)
        return KEPT[path]

    def _words(self, text: str) -> int:
        """How many words the tokenizer makes of a plain chunk: 1 for letters, 2 for letters and one closing mark; 0 for any other chunk."""
        if text.isalpha():
            body, n = text, 1
        elif text[-1] in CLOSERS and text[:-1].isalpha():
            body, n = text[:-1], 2
        else:
            return 0
        return n if body.isascii() or (is_normalized("NFC", body) and body.lower().isalpha()) else 0

    def _learn(self, chunks: list[bytes]) -> None:
        texts = [c.decode() for c in chunks]
        counts = list(map(self._words, texts)) if self.ends is not None else [0] * len(texts)
        plain = [i for i, n in enumerate(counts) if n]
        for a in range(0, len(plain), LOT * 20):
            self._learn_plain([chunks[i] for i in plain[a : a + LOT * 20]], [texts[i] for i in plain[a : a + LOT * 20]], [counts[i] for i in plain[a : a + LOT * 20]])
        rest = [i for i, n in enumerate(counts) if not n]
        self._learn_marked([chunks[i] for i in rest], [texts[i] for i in rest])

    def _learn_plain(self, chunks: list[bytes], texts: list[str], counts: list[int]) -> None:
        """Chunks whose number of words is known, side by side: every word's last id is one that ends a word."""
        lots = [" ".join(texts[i : i + LOT]) for i in range(0, len(texts), LOT)]
        found = np.concatenate([np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast(lots, add_special_tokens=False)])
        stops = 4 * (np.flatnonzero(self.ends[found]) + 1)
        last = np.cumsum(counts) - 1
        if len(stops) != last[-1] + 1:
            return self._learn_marked(chunks, texts)
        cuts, raw = stops[last].tolist(), found.tobytes()
        self.known.update(zip(chunks, [raw[a:b] for a, b in zip([0, *cuts[:-1]], cuts)]))
        return None

    def _learn_marked(self, chunks: list[bytes], texts: list[str]) -> None:
        """Any chunks, with a chunk between them whose single id no other chunk has."""
        known = self.known
        odd = range(len(texts)) if self.mark is None else [i for i, t in enumerate(texts) if MARK in t or "<" in t and any(s in t for s in self.special)]
        for i in odd:
            known[chunks[i]] = np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, dtype="<u4").tobytes()
        if odd:
            gone = set(odd)
            chunks = [c for i, c in enumerate(chunks) if i not in gone]
            texts = [t for i, t in enumerate(texts) if i not in gone]
        lots = [f" {MARK} ".join(texts[i : i + LOT]) + f" {MARK}" for i in range(0, len(texts), LOT)]
        at = 0
        for e in self.tokenizer.encode_batch_fast(lots, add_special_tokens=False):
            found = np.array(e.ids, dtype="<u4")
            raw, a = found.tobytes(), 0
            for b in (4 * np.flatnonzero(found == self.mark)).tolist():
                known[chunks[at]] = raw[a:b]
                at, a = at + 1, b + 4

    def _add(self, keys: np.ndarray, marks: np.ndarray, found: list[bytes]) -> None:
        """New chunks (in the order of their keys) with their ids into the cache."""
        sizes = np.array(list(map(len, found)), dtype=np.int64) // 4
        first = self.used + np.cumsum(sizes) - sizes
        self.used += int(sizes.sum())
        if self.used > len(self.flat):
            self.flat = np.concatenate([self.flat[: first[0]], np.zeros(2 * self.used - int(first[0]), dtype="<u4")])
        self.flat[first[0] : self.used] = np.frombuffer(b"".join(found), dtype="<u4")
        at = np.searchsorted(self.keys, keys)
        self.keys, self.marks, self.first, self.sizes = (np.insert(x, at, y) for x, y in ((self.keys, keys), (self.marks, marks), (self.first, first), (self.sizes, sizes)))
        bits = max(1, len(self.keys).bit_length())
        self.shift = U64(64 - bits)
        self.heads = np.concatenate([[0], np.cumsum(np.bincount((self.keys >> self.shift).astype(np.int64), minlength=1 << bits))])

    def _clear(self) -> None:
        self.keys = self.marks = np.zeros(0, dtype=U64)
        self.first = self.sizes = np.zeros(0, dtype=np.int64)
        self.flat, self.used = np.zeros(1 << 16, dtype="<u4"), 0
        self.shift, self.heads = U64(63), np.zeros(3, dtype=np.int64)

    def _find(self, keys: np.ndarray, marks: np.ndarray) -> np.ndarray:
        """Places in the cache, or -1."""
        lead = (keys >> self.shift).astype(np.int64)
        at, end = self.heads[lead], self.heads[lead + 1]
        out = np.full(len(keys), -1, dtype=np.int64)
        left = np.flatnonzero(at < end)
        at, end = at[left], end[left]
        while len(left):
            same = (self.keys[at] == keys[left]) & (self.marks[at] == marks[left])
            out[left[same]] = at[same]
            go = ~same & (at + 1 < end)
            left, at, end = left[go], at[go] + 1, end[go]
        return out

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each UTF-8 text."""
        raw = b"".join(texts)
        data = np.frombuffer(raw, dtype=np.uint8)
        words = split(data, np.concatenate([[0], np.cumsum(np.array(list(map(len, texts)), dtype=np.int64))]), NOT_SPACE)
        keys = words.hashes()
        room = np.zeros(len(data) + 8, dtype=np.uint8)
        room[: len(data)] = data
        marks = (np.ndarray((len(data) + 1,), dtype="<u8", buffer=room.data, strides=(1,))[words.starts] & _LEADING[np.minimum(words.lens, 8)]) * U64(31) + words.lens.astype(U64)
        at = self._find(keys, marks)
        open_ = np.flatnonzero(at < 0)
        if len(open_):
            own = open_[np.unique(keys[open_], return_index=True)[1]]
            starts, ends = words.starts[own], words.starts[own] + words.lens[own]
            chunks = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
            self.known = {}
            for i in range(0, len(chunks), CACHE):
                self._learn(list(dict.fromkeys(chunks[i : i + CACHE])))
            found = [self.known[c] for c in chunks]
            if len(self.keys) + len(own) > CACHE:  # what was found before goes with the cache, so all of these texts are looked up anew
                every = np.unique(keys, return_index=True)[1]
                mine = dict(zip(keys[own].tolist(), found))
                old = every[at[every] >= 0]
                mine |= {k: self.flat[f : f + n].tobytes() for k, f, n in zip(keys[old].tolist(), self.first[at[old]].tolist(), self.sizes[at[old]].tolist())}
                self._clear()
                self._add(keys[every], marks[every], [mine[k] for k in keys[every].tolist()])
            else:
                self._add(keys[own], marks[own], found)
            self.known = {}
            at = self._find(keys, marks)
        n = self.sizes[at]
        ends = np.concatenate([[0], np.cumsum(n)])
        out = self.flat[np.repeat(self.first[at] - ends[:-1], n) + np.arange(ends[-1])] if len(n) else self.flat[:0]
        cuts = ends[words.ptr].tolist()
        return [out[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]

    def batch(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text of an Arrow column; null counts as empty."""
        lot: list[bytes] = []
        size = 0
        for x in texts.cast(pa.binary()).fill_null(b""):
            raw = x.as_py()
            lot.append(raw)
            size += len(raw)
            if size >= SLICE_BYTES:
                yield from self.ids(lot)
                lot, size = [], 0
        yield from self.ids(lot)
        give_back()
