"""FM-index over words: wavelet matrix with packed bits, weighted backward search.

Built over the units of one shard (runs of words, parted by separators). The
suffix array of the units gives the Burrows-Wheeler transform; its symbols are
held bit by bit in a wavelet matrix with popcount ranks. Searches run for many
places at once, one step to the left each.
"""

from __future__ import annotations

import numpy as np

from feedplan.llm.repetition import suffix_ranks

_ONE = np.uint64(1)


class Bits:
    """A bit vector with rank."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(counts) - counts
        self.zeros = len(bits) - int(counts.sum())

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Set bits before each place."""
        word = at >> 6
        below = (_ONE << (at & 63).astype(np.uint64)) - _ONE
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class FMIndex:
    """`symbols` of all units one after the other; `size` and `weight` of each unit."""

    def __init__(self, symbols: np.ndarray, size: np.ndarray, weight: np.ndarray):
        values, dense = np.unique(symbols, return_inverse=True)
        self.units = len(size)
        self.first = np.cumsum(size + 1) - (size + 1)
        total = int((size + 1).sum())
        separators = self.first + size
        text = np.empty(total, np.int64)
        places = np.ones(total, bool)
        places[separators] = False
        text[places] = dense + 1
        text[separators] = -1 - np.arange(self.units)  # all different: a unit's suffixes are settled at its end
        rank = suffix_ranks(text, np.zeros(total, np.int8))[-1]
        text[separators] = 0
        self.text = text
        order = np.empty(total, np.int64)
        order[rank] = np.arange(total)
        self.weight = np.concatenate([[0], np.cumsum(np.repeat(weight, size + 1)[order])])
        counts = np.bincount(text, minlength=len(values) + 1)
        below = np.cumsum(counts) - counts
        last = text[order - 1]  # what comes before each suffix
        self.levels = []
        for bit in range(max(int(len(values)).bit_length(), 1) - 1, -1, -1):
            ones = (last >> bit) & 1
            self.levels.append((bit, Bits(ones.astype(np.uint8))))
            last = np.concatenate([last[ones == 0], last[ones == 1]])
        # where the block of a symbol begins in the last level, and where its suffixes begin
        block = np.zeros(len(counts), np.int64)
        new = np.flatnonzero(np.diff(last, prepend=-1))
        block[last[new]] = new
        self.shift = below - block
        self.total = total

    def left(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the suffixes that begin with the symbol and go on as those of the given intervals."""
        both = np.concatenate([low, high])
        twice = np.concatenate([symbol, symbol])
        for bit, bits in self.levels:
            ones = bits.ones(both)
            both = np.where((twice >> bit) & 1, bits.zeros + ones, both - ones)
        both += self.shift[twice]
        return both[: len(low)], both[len(low) :]

    def matched(self, end: np.ndarray, most: np.ndarray, least: int) -> np.ndarray:
        """Matching statistics: symbols to the left of each place (at most `most`) that occur together with a total weight of `least`."""
        out = np.zeros(len(end), np.int64)
        active = np.flatnonzero(most > 0)
        low, high = np.zeros(len(active), np.int64), np.full(len(active), self.total, np.int64)
        step = 0
        while len(active):
            step += 1
            low, high = self.left(low, high, self.text[end[active] - step])
            good = self.weight[high] - self.weight[low] >= least
            out[active[good]] = step
            good &= most[active] > step
            active, low, high = active[good], low[good], high[good]
        return out

    def repeated_windows(self, width: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(unit, first, last): windows of `width` symbols with starts first to last that occur with a weight of two."""
        found = []
        sizes = np.diff(np.append(self.first, self.total)) - 1
        unit, end = np.arange(self.units), sizes.copy()
        while len(unit := unit[keep := end >= width]):
            end = end[keep]
            length = self.matched(self.first[unit] + end, end, 2)
            hit = length >= width
            found.append((unit[hit], (end - length)[hit], end[hit] - width))
            # the run from `stop` to `end` is unique: go on with the windows that do not hold its unique head
            stop = end - length - 1
            rest = stop >= 0
            unit, end, stop = unit[rest], end[rest], stop[rest]
            head = np.minimum(end - stop, width + 1)
            open_ = np.arange(len(unit))
            for size in (1, 2, 3, 4, 6, 8, 12, 16, 24):
                open_ = open_[head[open_] > size]
                if not len(open_):
                    break
                tries = self.matched(self.first[unit[open_]] + stop[open_] + size, np.full(len(open_), size), 2)
                unique = tries < size
                head[open_[unique]] = size
                open_ = open_[~unique]
            end = stop + head - 1
        return found
