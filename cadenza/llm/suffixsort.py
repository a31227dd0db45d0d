"""External induced sorting of the suffixes of a shard.

The order of a string's suffixes is induced from the order of its LMS suffixes, which comes from the same procedure on the
string of their names. Both induction passes run over a queue whose entries are suffix tuples ordered by leading
character and, within one, by when they came; characters are taken off in ranges of bounded size, and what a range
has added to itself is put in order before it goes out. Queue, text, types and the orders are files in ``folder`` as soon as they are
larger than ``limit`` items, so a shard may be far larger than memory.
"""

from __future__ import annotations

import os
import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np

RANGE = 1 << 16
LIMIT = 1 << 21


class Store:
    """Arrays in memory, or as files where they have more than ``limit`` items."""

    def __init__(self, folder: str, limit: int = LIMIT):
        self.folder, self.limit = folder, limit

    def path(self) -> str:
        return f"{self.folder}/{uuid.uuid4().hex}"

    def array(self, n: int, dtype) -> np.ndarray:
        if n <= self.limit:
            return np.zeros(n, dtype=dtype)
        return np.memmap(self.path(), dtype=dtype, mode="w+", shape=(n,))

    def drop(self, *arrays: np.ndarray) -> None:
        for a in arrays:
            if isinstance(a, np.memmap):
                os.unlink(a.filename)


class Queue:
    """A monotone priority queue of suffixes by range of leading characters; within a range, first in first out."""

    def __init__(self, store: Store):
        self.store, self.held, self.files, self.size = store, defaultdict(list), {}, 0

    def push(self, ranges: np.ndarray, places: np.ndarray) -> None:
        if not len(places):
            return
        if int(ranges.max()) < 1 << 16:
            ranges = ranges.astype(np.uint16)  # sorted by digits
        order = np.argsort(ranges, kind="stable")
        ranges, places = ranges[order], places[order]
        cuts = np.flatnonzero(ranges[1:] != ranges[:-1]) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ranges)]):
            self.held[int(ranges[a])].append(places[a:b])
        self.size += len(places)
        if self.size > self.store.limit:
            self._spill()

    def _spill(self) -> None:
        for r, parts in self.held.items():
            with open(self.files.setdefault(r, self.store.path()), "ab") as f:
                for p in parts:
                    f.write(p.astype(np.int64).tobytes())
        self.held.clear()
        self.size = 0

    def pop(self, r: int) -> np.ndarray:
        parts = self.held.pop(r, [])
        self.size -= sum(map(len, parts))
        if r in self.files:
            name = self.files.pop(r)
            parts = [np.fromfile(name, dtype=np.int64), *parts]
            os.unlink(name)
        return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)


class Sequence:
    """An order of suffixes, written once from front to back."""

    def __init__(self, store: Store, n: int):
        self.store, self.places, self.n = store, store.array(n, np.int64), 0

    def add(self, places: np.ndarray) -> None:
        self.places[self.n : self.n + len(places)] = places
        self.n += len(places)


def char_ranges(text: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """(the range of each character, whether a range is of one character): about RANGE suffixes each; a character that follows itself is alone."""
    counts = np.zeros(top + 1, dtype=np.int64)
    twin = np.zeros(top + 1, dtype=bool)
    for a in range(0, len(text), 1 << 22):
        part = np.asarray(text[a : a + (1 << 22) + 1])
        counts += np.bincount(part[: 1 << 22], minlength=top + 1)
        twin[part[:-1][part[:-1] == part[1:]]] = True
    alone = twin | (counts > RANGE)
    fill = np.where(alone, 0, counts).cumsum() // RANGE
    new = np.ones(top + 1, dtype=bool)
    new[1:] = alone[1:] | alone[:-1] | (fill[1:] != fill[:-1])
    return np.cumsum(new) - 1, alone[np.flatnonzero(new)]


def _before(places: np.ndarray, want: np.ndarray) -> np.ndarray:
    """The places before ``places`` that are wanted."""
    at = places - 1
    at = at[at >= 0]
    return at[want[at]]


def induce(text: np.ndarray, flip: int | None, want: np.ndarray, seeds: Iterator[np.ndarray], ranges: np.ndarray, single: np.ndarray, store: Store, out: Sequence) -> None:
    """Puts the wanted suffixes in order between the sorted ``seeds``, all by ascending range.

    A popped suffix induces the one before it if that is wanted. Under each character the wanted ones come first, then
    the seeds. ``flip`` turns the characters round (for the pass from the largest to the smallest).
    """
    queue, last = Queue(store), len(single) - 1

    def char(places: np.ndarray) -> np.ndarray:
        c = np.asarray(text[places]).astype(np.int64)
        return c if flip is None else flip - c

    def range_of(c: np.ndarray) -> np.ndarray:
        return ranges[c] if flip is None else last - ranges[flip - c]

    pending = np.zeros(0, dtype=np.int64)
    pending_range = pending
    source = iter(seeds)
    for r in range(last + 1):
        alone = single[r] if flip is None else single[last - r]
        mine = queue.pop(r)
        got = []
        while True:
            if len(pending):
                n = int(np.searchsorted(pending_range, r, side="right"))
                got.append(pending[:n])
                pending, pending_range = pending[n:], pending_range[n:]
                if len(pending):
                    break
            more = next(source, None)
            if more is None:
                break
            pending = more
            pending_range = range_of(char(more))
        own = np.concatenate(got) if got else np.zeros(0, dtype=np.int64)
        if not len(mine) and not len(own):
            continue
        if alone:
            wave = mine
            while len(wave):
                out.add(wave)
                before = _before(wave, want)
                to = range_of(char(before))
                queue.push(to[to != r], before[to != r])
                wave = before[to == r]
            done = own
            out.add(done)
        else:
            done = _settle(mine, own, want, char, range_of, r)
            out.add(done)
        before = _before(done, want)
        to = range_of(char(before))
        queue.push(to[to != r], before[to != r])


def _settle(mine: np.ndarray, seeds: np.ndarray, want: np.ndarray, char, range_of, r: int) -> np.ndarray:
    """One range of several characters in order, with all that it induces within itself."""
    lots, parents = [mine, seeds], [np.full(len(mine) + len(seeds), -1)]
    front, base, depth = np.concatenate(lots), 0, 0
    total = len(front)
    while len(front):
        at = front - 1
        ok = np.flatnonzero(at >= 0)
        ok = ok[want[at[ok]]]
        ok = ok[range_of(char(at[ok])) == r]
        if not len(ok):
            break
        lots.append(at[ok])
        parents.append(ok + base)
        base, front, depth = total, at[ok], depth + 1
        total += len(ok)
    places, parent = np.concatenate(lots), np.concatenate(parents)
    # under each character: what was there first, then what came from within the range, then the seeds
    rank = char(places) * 3
    rank -= rank.min()
    rank[len(mine) : len(mine) + len(seeds)] += 2
    rank[len(mine) + len(seeds) :] += 1
    if int(rank.max()) < 1 << 16:
        rank = rank.astype(np.uint16)
    order = np.argsort(rank, kind="stable")
    inner = np.arange(len(mine) + len(seeds), total)
    for _ in range(depth):
        place = np.empty(total, dtype=np.int64)
        place[order] = np.arange(total)
        again = np.concatenate([np.arange(len(mine) + len(seeds)), inner[np.argsort(place[parent[inner]], kind="stable")]])
        order = again[np.argsort(rank[again], kind="stable")]
    return places[order]


def _types(text: np.ndarray, store: Store) -> np.ndarray:
    """Whether each suffix is smaller than the next (S type); worked out from the end."""
    n = len(text)
    out = store.array(n, bool)
    follow = True
    step = 1 << 22
    for b in range(n, 0, -step):
        a = max(0, b - step)
        part = np.asarray(text[a : min(n, b + 1)])
        if b == n:
            part = np.append(part, -1)
        here, after = part[:-1].astype(np.int64), part[1:].astype(np.int64)
        turn = np.flatnonzero(here != after)
        at = np.searchsorted(turn, np.arange(len(here)))
        known = at < len(turn)
        small = np.empty(len(here), dtype=bool)
        small[known] = (here < after)[turn[at[known]]]
        small[~known] = follow
        if b == n:
            small[-1] = True
        out[a:b] = small
        follow = bool(small[0])
    return out


def _lms(small: np.ndarray) -> Iterator[np.ndarray]:
    """Places of S type after one of L type, in lots."""
    step = 1 << 22
    for a in range(0, len(small), step):
        part = np.asarray(small[max(0, a - 1) : a + step])
        found = np.flatnonzero(part[1:] & ~part[:-1]) + 1 + max(0, a - 1)
        yield found


def _chunks(a: np.ndarray, n: int, step: int = 1 << 20) -> Iterator[np.ndarray]:
    for i in range(0, n, step):
        yield np.asarray(a[i : min(n, i + step)])


def _backwards(a: np.ndarray, n: int, step: int = 1 << 20) -> Iterator[np.ndarray]:
    for b in range(n, 0, -step):
        yield np.asarray(a[max(0, b - step) : b])[::-1]


def _both(text: np.ndarray, small: np.ndarray, seeds: Iterator[np.ndarray], top: int, cut: tuple[np.ndarray, np.ndarray], store: Store) -> Sequence:
    """All suffixes from the largest to the smallest, induced from the sorted LMS ``seeds``."""
    n = len(text)
    large = store.array(n, bool)
    np.logical_not(small, out=large)
    first = Sequence(store, n)
    induce(text, None, large, seeds, *cut, store, first)
    only = (x[large[x]] for x in _backwards(first.places, first.n))
    second = Sequence(store, n)
    induce(text, top, small, only, *cut, store, second)
    second.add(np.array([n - 1]))  # the last character's suffix, which none induces
    store.drop(large, first.places)
    return second


def sort_suffixes(text: np.ndarray, store: Store) -> np.ndarray:
    """Places of all suffixes in ascending order; the last character must be 0 and the only one of it."""
    n = len(text)
    if n == 1:
        return np.zeros(1, dtype=np.int64)
    top = int(max(int(np.max(x)) for x in _chunks(text, n, 1 << 22)))
    small = _types(text, store)
    cut = char_ranges(text, top)
    places = np.concatenate(list(_lms(small)))
    by_char = places[np.argsort(np.asarray(text[places]), kind="stable")]
    rough = _both(text, small, iter([by_char]), top, cut, store)
    is_lms = store.array(n, bool)
    is_lms[places] = True
    order = np.concatenate([x[is_lms[x]] for x in _backwards(rough.places, rough.n)])
    store.drop(rough.places, is_lms)
    names, distinct = _names(text, places, order)
    if distinct < len(places):
        order = places[sort_suffixes(names, store)]
    final = _both(text, small, _chunks(order, len(order)), top, cut, store)
    out = store.array(n, np.int64)
    at = 0
    for x in _backwards(final.places, final.n):
        out[at : at + len(x)] = x
        at += len(x)
    store.drop(small, final.places)
    return out


def _names(text: np.ndarray, places: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, int]:
    """The names of the LMS substrings in text order, equal ones alike and ordered as the substrings are; and how many there are."""
    nth = np.searchsorted(places, order)
    lens = np.append(np.diff(places), 0)[nth] + 1
    same = np.zeros(len(order), dtype=bool)
    live = np.flatnonzero(lens[1:] == lens[:-1]) + 1
    k = 0
    while len(live):
        ended = lens[live] <= k
        same[live[ended]] = True
        live = live[~ended]
        live = live[np.asarray(text[order[live] + k]) == np.asarray(text[order[live - 1] + k])]
        k += 1
    name = np.cumsum(~same) - 1
    out = np.empty(len(order), dtype=np.int64)
    out[nth] = name
    return out, int(name[-1]) + 1
