"""Answers for byte spans that a Python worker has met before.

Spans of a batch (words, say) are found by numpy in a table of fixed size, so
there is no Python object and no dictionary look-up for each occurrence. A hash
finds the entry, a comparison of the bytes confirms it. Only spans that are new
are handed to the function that knows the answer.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from feedplan.llm.words import span_hashes


#: Bytes that are compared at once.
_PART = 1 << 20


class Ragged:
    """A growing list of arrays, in one flat array."""

    def __init__(self, kind: type | str):
        self.flat, self.used = np.empty(1 << 12, kind), 0
        self.begin, self.size, self.n = np.empty(1 << 8, np.int64), np.empty(1 << 8, np.int64), 0

    def append(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        self.flat = _room(self.flat, self.used, len(flat))
        self.begin, self.size = _room(self.begin, self.n, len(sizes)), _room(self.size, self.n, len(sizes))
        self.flat[self.used : self.used + len(flat)] = flat
        to = slice(self.n, self.n + len(sizes))
        self.begin[to], self.size[to] = self.used + np.cumsum(sizes) - sizes, sizes
        self.used, self.n = self.used + len(flat), self.n + len(sizes)

    def take(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The arrays of these entries one after the other, and their sizes."""
        sizes = self.size[entries]
        return self.flat[places(self.begin[entries], sizes)], sizes

    def keep(self, entries: np.ndarray) -> None:
        """Forget all other arrays; those that stay are numbered anew."""
        flat, sizes = self.take(entries)
        self.used = self.n = 0
        self.append(flat, sizes)


def _room(array: np.ndarray, used: int, more: int) -> np.ndarray:
    if used + more <= len(array):
        return array
    out = np.empty(max(2 * len(array), used + more), array.dtype)
    out[:used] = array[:used]
    return out


def places(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers begin, begin + 1, … of each span."""
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


class SpanMemory:
    """`learn` gets new spans in order and returns, for each column of answers, all arrays in one and their sizes.

    Beyond `most` entries those that were met only once make room; that bounds
    the memory and has no influence on answers.
    """

    def __init__(self, learn: Callable[[list[bytes]], list[tuple[np.ndarray, np.ndarray]]], kinds: list, most: int):
        self._learn, self._most = learn, most
        self.columns = [Ragged(k) for k in kinds]
        self._spans = Ragged(np.uint8)
        self._hash, self._uses = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._led = np.zeros(0, bool)  # whether the hash leads to the entry
        self._table = np.full(1 << 10, -1, np.int32)

    def find(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The entry of each span (not empty) in the columns; valid until the next call."""
        if self._spans.n > self._most:
            self._make_room()
        hashes = span_hashes(data, start, end) if len(start) else np.zeros(0, np.uint64)
        entry = self._entries(hashes)
        new = np.flatnonzero(entry < 0)
        if len(new):
            _, first = np.unique(hashes[new], return_index=True)
            first = new[first]
            spans = [data[a:b].tobytes() for a, b in zip(start[first].tolist(), end[first].tolist(), strict=True)]
            order = sorted(range(len(spans)), key=spans.__getitem__)
            self._add([spans[i] for i in order], hashes[first[order]])
            entry[new] = self._entries(hashes[new])
        other = np.flatnonzero(~self._same(data, start, end - start, entry))
        if len(other):  # two spans with one hash: these get entries that no hash leads to
            entry[other] = self._spans.n + np.arange(len(other))
            self._add([data[a:b].tobytes() for a, b in zip(start[other].tolist(), end[other].tolist(), strict=True)], None)
        self._uses += np.bincount(entry, minlength=len(self._uses))
        return entry

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(65 - len(self._table).bit_length())).astype(np.int64)

    def _entries(self, hashes: np.ndarray) -> np.ndarray:
        slot = self._slots(hashes)
        out = self._table[slot].astype(np.int64)
        if not len(self._hash):
            return out
        more = np.flatnonzero((out >= 0) & (self._hash[out] != hashes))
        while len(more):
            slot[more] = (slot[more] + 1) & (len(self._table) - 1)
            out[more] = self._table[slot[more]]
            more = more[(out[more] >= 0) & (self._hash[out[more]] != hashes[more])]
        return out

    def _same(self, data: np.ndarray, start: np.ndarray, size: np.ndarray, entry: np.ndarray) -> np.ndarray:
        """Whether each span has the bytes of its entry; compared in parts of bounded size."""
        out = self._spans.size[entry] == size
        equal, begin = np.flatnonzero(out), 0
        total = np.cumsum(size[equal])
        while begin < len(equal):
            end = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + _PART, "right")))
            at = equal[begin:end]
            differ = data[places(start[at], size[at])] != self._spans.take(entry[at])[0]
            out[at] = ~np.logical_or.reduceat(differ, np.cumsum(size[at]) - size[at])
            begin = end
        return out

    def _add(self, spans: list[bytes], hashes: np.ndarray | None) -> None:
        for column, (flat, sizes) in zip(self.columns, self._learn(spans), strict=True):
            column.append(flat, sizes)
        sizes = np.fromiter(map(len, spans), np.int64, len(spans))
        self._spans.append(np.frombuffer(b"".join(spans), np.uint8), sizes)
        first = len(self._hash)
        self._hash = np.append(self._hash, np.zeros(len(spans), np.uint64) if hashes is None else hashes)
        self._uses = np.append(self._uses, np.zeros(len(spans), np.int64))
        self._led = np.append(self._led, np.full(len(spans), hashes is not None))
        if 2 * len(self._hash) > len(self._table):
            self._table = np.full(1 << (4 * len(self._hash)).bit_length(), -1, np.int32)
            self._insert(np.flatnonzero(self._led).astype(np.int32))
        elif hashes is not None:
            self._insert(np.arange(first, first + len(spans), dtype=np.int32))

    def _insert(self, entries: np.ndarray) -> None:
        slot = self._slots(self._hash[entries])
        while len(entries):
            free = self._table[slot] < 0
            at, first = np.unique(slot[free], return_index=True)
            self._table[at] = entries[free][first]
            rest = self._table[slot] != entries
            entries, slot = entries[rest], (slot[rest] + 1) & (len(self._table) - 1)

    def _make_room(self) -> None:
        kept = np.flatnonzero(self._led & (self._uses > 1))
        if len(kept) > self._most // 2:
            kept = kept[self._uses[kept] > np.median(self._uses[kept])]
        for column in (*self.columns, self._spans):
            column.keep(kept)
        self._hash, self._led = self._hash[kept], self._led[kept]
        self._uses = np.zeros(len(kept), np.int64)
        self._table[:] = -1
        self._insert(np.arange(len(kept), dtype=np.int32))
