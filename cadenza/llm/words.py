"""Words of whole texts as arrays: splitting and hashing for Arrow batches without a Python loop over words."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: A batch's texts are worked on in runs of so many bytes (one longer text stays whole).
SLICE_BYTES = 2 << 20
#: What a worker keeps from one task to the next (tokenizers with their caches). Tasks that take texts by words have no use for it.
KEPT: dict[str, object] = {}

_bytes = np.arange(256, dtype=np.uint8)
AS_IS = _bytes.copy()
LOWER = _bytes.copy()
LOWER[ord("A") : ord("Z") + 1] += 32
#: ``[^\x20\x09-\x0D]+``
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``: digits, small letters and all beyond ASCII
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64's)."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


@dataclass
class Words:
    """Words of some documents: byte ``starts`` and ``lens`` in ``data``; document i has words ``ptr[i]:ptr[i+1]``."""

    data: np.ndarray
    starts: np.ndarray
    lens: np.ndarray
    ptr: np.ndarray

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.starts[i] + self.lens[i]].tobytes()

    def hashes(self, seed: int = 0) -> np.ndarray:
        """64 bits of each word's bytes."""
        return hash_spans(self.data, self.starts, self.lens, seed)


def hash_spans(data: np.ndarray, starts: np.ndarray, lens: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of byte spans, eight bytes a step."""
    room = np.zeros(len(data) + 8, dtype=np.uint8)
    room[: len(data)] = data
    eight = np.ndarray((len(data) + 1,), dtype="<u8", buffer=room.data, strides=(1,))
    keep = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], dtype=U64)
    h = mix(lens.astype(U64) * U64(0x9E3779B97F4A7C15) + U64(seed * 2 + 1))
    live, at, left = None, starts, lens
    while len(at):
        part = mix((eight[at] & keep[np.minimum(left, 8)]) + U64(0xD6E8FEB86659FD93))
        if live is None:
            h = mix(h ^ part)
        else:
            h[live] = mix(h[live] * U64(3) ^ part)
        more = np.flatnonzero(left > 8)
        live = more if live is None else live[more]
        at, left = at[more] + 8, left[more] - 8
    return h


def split(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, fold: np.ndarray = AS_IS) -> Words:
    """Words of the documents ``data[offsets[i]:offsets[i+1]]``; a word never crosses documents."""
    data = fold[data] if fold is not AS_IS else data
    inside = is_word[data]
    opens, closes = inside.copy(), inside.copy()
    if len(data):
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        edges = offsets[1:-1]
        edges = edges[(edges > 0) & (edges < len(data))]
        opens[edges] = inside[edges]
        closes[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(opens)
    return Words(data, starts, np.flatnonzero(closes) + 1 - starts, np.searchsorted(starts, offsets))


def give_back() -> None:
    """Returns what this worker has freed to the machine: idle workers of earlier stages would keep it beside those that work."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) over a batch; null texts are empty."""
    KEPT.clear()
    texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    n = len(texts)
    if not n:
        return
    _, raw_offsets, raw = texts.buffers()
    offsets = np.frombuffer(raw_offsets, dtype=np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last
    give_back()


class Powers:
    """Rolling polynomial hashes modulo 2**64: the hash of items i to j is ``(C[j] - C[i]) * inverse**i``."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=U64)

    def sized(self, n: int) -> None:
        while len(self.up) < n + 1:
            m = len(self.up)
            self.up = np.concatenate([self.up, self.up * U64(pow(self.base, m, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * U64(pow(self.inverse, m, 1 << 64))])

    def sums(self, items: np.ndarray) -> np.ndarray:
        self.sized(len(items))
        out = np.zeros(len(items) + 1, dtype=U64)
        np.cumsum(items * self.up[: len(items)], out=out[1:])
        return out

    def spans(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        self.sized(len(sums))
        return mix((sums[end] - sums[start]) * self.down[start])

    def windows(self, sums: np.ndarray, k: int) -> np.ndarray:
        """Of every k consecutive items."""
        self.sized(len(sums))
        n = max(0, len(sums) - k)
        return mix((sums[k:] - sums[:n]) * self.down[:n])


def sliding(values: np.ndarray, width: int, pick=np.minimum) -> np.ndarray:
    """``pick`` over every ``width`` consecutive values."""
    done, out = 1, values
    while done < width:
        step = min(done, width - done)
        out = pick(out[:-step], out[step:]) if len(out) > step else out[:0]
        done += step
    return out
