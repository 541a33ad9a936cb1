"""Prefix tables of many short byte strings, filled side by side.

The table of one string is that of `bpe.PrefixTable`: for each prefix the one
token that its encoding ends with. Strings do not depend on each other, so the
entries of all prefixes of one length are found in one numpy step. Candidates
come from a trie of the reversed tokens; whether a candidate may follow the
token before it is looked up in a table of pairs of fixed size, and asked from
`Merges` where the table does not have it.
"""

from __future__ import annotations

import numpy as np

from feedplan.llm.merges import Merges

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


class IntMap:
    """A fixed map from non-negative integers to integers, asked for many keys at once; -1 where a key is unknown."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(4 * len(keys)).bit_length())
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._keys, self._values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int64)
        slot = self._slots(keys)
        while len(keys):
            free = self._keys[slot] < 0
            at, first = np.unique(slot[free], return_index=True)
            self._keys[at], self._values[at] = keys[free][first], values[free][first]
            rest = self._keys[slot] != keys
            keys, values, slot = keys[rest], values[rest], (slot[rest] + 1) & self._mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * _GOLDEN >> self._shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slots(keys)
        held = self._keys[slot]
        out = np.where(held == keys, self._values[slot], -1)
        more = np.flatnonzero((held != keys) & (held >= 0))
        while len(more):
            slot[more] = (slot[more] + 1) & self._mask
            held = self._keys[slot[more]]
            hit = held == keys[more]
            out[more[hit]] = self._values[slot[more[hit]]]
            more = more[~hit & (held >= 0)]
        return out


class PrefixTables:
    """Encodes many strings of up to `longest` bytes at once. Tokens are numbered as in `tokens`."""

    def __init__(self, merges: Merges, tokens: list[bytes], pairs: int = 20):
        self.merges, self.tokens = merges, tokens
        self._pair_shift = np.uint64(64 - pairs)
        self._pairs, self._fits = np.full(1 << pairs, -1, np.int64), np.zeros(1 << pairs, bool)
        arcs: dict[int, int] = {}
        token_of = [-1]
        for number, token in enumerate(tokens):
            if not merges.whole(token):
                continue
            node = 0
            for byte in reversed(token):
                key = node << 8 | byte
                node = arcs.get(key, -1)
                if node < 0:
                    node = arcs[key] = len(token_of)
                    token_of.append(-1)
            token_of[node] = number
        self._arcs = IntMap(np.fromiter(arcs.keys(), np.int64, len(arcs)), np.fromiter(arcs.values(), np.int64, len(arcs)))
        self._token_of = np.array(token_of, np.int32)

    def _follows(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether each token may stand behind the one before it; -1 is the beginning."""
        out = before < 0
        asked = np.flatnonzero(~out)
        keys = before[asked].astype(np.int64) * len(self.tokens) + token[asked]
        slot = (keys.astype(np.uint64) * _GOLDEN >> self._pair_shift).astype(np.int64)
        out[asked] = self._fits[slot]
        new = np.flatnonzero(self._pairs[slot] != keys)
        if len(new):
            distinct, place = np.unique(keys[new], return_inverse=True)
            fits, names = self.merges.fits, self.tokens
            found = np.array([fits(names[k // len(names)], names[k % len(names)]) for k in distinct.tolist()], bool)[place]
            out[asked[new]] = found
            self._pairs[slot[new]], self._fits[slot[new]] = keys[new], found
        return out

    def _candidates(self, data: np.ndarray, inner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens that end behind each byte, longest first: their sizes, their numbers, and the first of each byte."""
        at, node, size = np.arange(len(data)), np.zeros(len(data), np.int64), 0
        found = []
        while len(at):
            node = self._arcs(node << 8 | data[at - size])
            size += 1
            good = node >= 0
            at, node = at[good], node[good]
            token = self._token_of[node]
            ends = token >= 0
            found.append((at[ends], np.full(int(ends.sum()), size, np.int32), token[ends]))
            good = inner[at] >= size
            at, node = at[good], node[good]
        place, sizes, tokens = (np.concatenate([x[i] for x in reversed(found)]) for i in range(3))
        order = np.argsort(place, kind="stable")
        return sizes[order], tokens[order], np.searchsorted(place[order], np.arange(len(data) + 1))

    def encode(self, strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the tokens of all strings, and where those of each string end; strings are not empty."""
        lengths = np.fromiter(map(len, strings), np.int64, len(strings))
        data = np.frombuffer(b"".join(strings), np.uint8).astype(np.int64)
        start = np.cumsum(lengths) - lengths
        inner = np.arange(len(data)) - np.repeat(start, lengths)
        sizes, tokens, first = self._candidates(data, inner)
        last, width = np.full(len(data), -1, np.int32), np.zeros(len(data), np.int32)
        by_place = np.argsort(inner, kind="stable")
        bounds = np.searchsorted(inner[by_place], np.arange(int(lengths.max(initial=0)) + 1))
        for k in range(len(bounds) - 1):
            open_ = by_place[bounds[k] : bounds[k + 1]]
            next_ = first[open_]
            while len(open_):
                if (next_ >= first[open_ + 1]).any():
                    raise ValueError("the vocabulary has no token for a byte")
                size, token = sizes[next_], tokens[next_]
                good = self._follows(np.where(size > k, -1, last[open_ - size]), token)
                last[open_[good]], width[open_[good]] = token[good], size[good]
                open_, next_ = open_[~good], next_[~good] + 1
        # read off from the end: round r finds the r-th token from behind of every string that has as many
        string, end, found = np.arange(len(strings)), start + lengths - 1, []
        while len(string):
            found.append((string, last[end]))
            end = end - width[end]
            more = end >= start[string]
            string, end = string[more], end[more]
        string, token = (np.concatenate([x[i] for x in reversed(found)]) if found else np.zeros(0, np.int64) for i in range(2))
        order = np.argsort(string, kind="stable")
        return token[order], np.cumsum(np.bincount(string, minlength=len(strings)))
