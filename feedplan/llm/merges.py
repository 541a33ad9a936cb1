"""Byte-pair merges, seen from the boundary between two tokens.

Encoding merges the adjacent pair of lowest rank, leftmost first, until no
pair has a rank. Every token is therefore a binary tree of merges, and whether
two tokens can stand side by side in an encoding depends on the right edge of
the first tree and the left edge of the second one alone: along both edges, in
the order of their merges, no pair across the boundary may come first. So a
byte string has exactly one encoding, each of its prefixes has exactly one
last token, and that token is found from shorter prefixes.
"""

from __future__ import annotations

from collections.abc import Callable

#: Ends the last unit of a word in vocabularies with word ends; the byte occurs in no UTF-8 text.
END = b"\xff"
NEVER = 1 << 60


def units(token: bytes) -> list[bytes]:
    """The single bytes that merging starts from; a word end belongs to the byte before it."""
    ended = token.endswith(END) and len(token) > 1
    body = token[:-1] if ended else token
    out = [body[i : i + 1] for i in range(len(body))]
    if ended:
        out[-1] += END
    return out


class Merges:
    """`rank(left, right)` is the rank of a merge, or NEVER; `known` are the tokens that may be emitted."""

    def __init__(self, rank: Callable[[bytes, bytes], int], known: set[bytes] | dict[bytes, int]):
        self.rank, self.known = rank, known
        self.longest = max(map(len, known))
        #: Bytes of the longest token that ends with three given ones.
        self._reach: dict[bytes, int] = {}
        for token in known:
            tail = token[-3:]
            if len(token) >= 3 and len(token) > self._reach.get(tail, 0):
                self._reach[tail] = len(token)
        self._halves: dict[bytes, tuple[bytes, bytes] | None] = {}
        self._edges: dict[tuple[bytes, bool], list[tuple[bytes, int]]] = {}
        self._fits: dict[tuple[bytes, bytes], bool] = {}
        self._whole: dict[bytes, bool] = {}

    def halves(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two tokens of the last merge; None for a unit, and for a token that merging never builds."""
        if token not in self._halves:
            parts = units(token)
            while len(parts) > 2:
                ranks = [self.rank(a, b) for a, b in zip(parts, parts[1:], strict=False)]
                at = ranks.index(min(ranks))
                if ranks[at] == NEVER:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            good = len(parts) == 2 and self.rank(*parts) != NEVER
            self._halves[token] = (parts[0], parts[1]) if good else None
        return self._halves[token]

    def whole(self, token: bytes) -> bool:
        """Whether the token encodes as itself."""
        known = self._whole.get(token)
        if known is None:
            known = self._whole[token] = len(units(token)) == 1 or self.halves(token) is not None
        return known

    def _edge(self, token: bytes, right: bool) -> list[tuple[bytes, int]]:
        """Nodes along one edge of the merge tree from the unit up, each with the rank of the merge that ends it."""
        if (token, right) not in self._edges:
            out, until, node = [], NEVER, token
            while True:
                out.append((node, until))
                halves = self.halves(node) if len(node) > 1 else None
                if halves is None:
                    break
                until, node = self.rank(*halves), halves[right]
            self._edges[token, right] = out[::-1]
        return self._edges[token, right]

    def fits(self, a: bytes, b: bytes) -> bool:
        """Whether b can follow a: no merge across their boundary comes before the merges that build them."""
        known = self._fits.get((a, b))
        if known is None:
            known = self._fits[a, b] = self._apart(self._edge(a, True), self._edge(b, False))
            if len(self._fits) > 1 << 18:  # a bound on memory only: answers are found again
                self._fits.clear()
        return known

    def _apart(self, left: list[tuple[bytes, int]], right: list[tuple[bytes, int]]) -> bool:
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = left[i], right[j]
            across = self.rank(x, y)
            if across < x_ends and across <= y_ends:  # of equal ranks the leftmost goes first
                return False
            if x_ends == y_ends == NEVER:
                return True
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1

    def extend(self, data: bytes, size: int, before: list[bytes]) -> None:
        """Append the last tokens of the prefixes longer than `size`; `last` for many prefixes in a row."""
        known, whole, fits, reach = self.known, self._whole, self._fits, self._reach.get
        for end in range(size + 1, len(data) + 1):
            first = end - reach(data[end - 3 : end], 2) if end > 2 else 0
            for start in range(first if first > 0 else 0, end):
                token = data[start:end]
                if token in known and (not start or fits.get((before[start], token)) or self.fits(before[start], token)):
                    if whole.get(token) or self.whole(token):
                        before.append(token)
                        break
            else:
                raise ValueError(f"the vocabulary has no token for byte {data[end - 1]:#x}")

    def last(self, data: bytes, end: int, before: list[bytes], suffix: bytes = b"") -> bytes:
        """The last token of data[:end] + suffix; before[i] is the last token of data[:i]."""
        known, whole, fits = self.known, self._whole, self._fits
        for start in range(end - self.longest if end > self.longest else 0, end):
            token = data[start:end] + suffix
            if token in known and (whole.get(token) or self.whole(token)):
                if not start:
                    return token
                pair = (before[start], token)
                if fits[pair] if pair in fits else self.fits(*pair):
                    return token
        raise ValueError(f"the vocabulary has no token for byte {data[end - 1]:#x}")
