"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For each prefix of a piece of text the table holds the one token that the
encoding of this prefix ends with. The tokens of the whole piece are read off
from its end. A prefix never depends on what follows, so appending extends the
table, and an edit keeps every entry before it.

Defined results: null is the empty text; the empty text has no tokens; every
text decodes to its own bytes; equal rows give equal results; other columns
are kept as they are, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedplan.llm.merges import NEVER, Merges
from feedplan.llm.prefix_tables import PrefixTables
from feedplan.llm.words import slices, small_batches

#: Pieces whose tokens a Python worker remembers: bounds its memory, not the result.
REMEMBERED = 300_000
#: Bytes of a piece up to which tables are filled side by side, and bytes of pieces that are taken at once.
SHORT, TOGETHER = 64, 1 << 18


class PrefixTable:
    """Tokens of one growing or edited byte string."""

    def __init__(self, merges: Merges, data: bytes = b""):
        self.merges, self.data, self.last = merges, b"", [b""]
        self.append(data)

    def append(self, more: bytes) -> PrefixTable:
        start = len(self.data)
        self.data += more
        self.merges.extend(self.data, start, self.last)
        return self

    def cut(self, size: int) -> PrefixTable:
        """Keep the first bytes only."""
        self.data = self.data[:size]
        del self.last[size + 1 :]
        return self

    def edit(self, start: int, end: int, new: bytes) -> PrefixTable:
        """Replace bytes start to end. Entries before are kept; once the last tokens of `longest` bytes in a
        row agree with the old ones, so do all that follow."""
        old_last, old_end, rest = self.last, end, self.data[end:]
        self.data = self.data[:start]
        self.last = old_last[: start + 1]
        self.append(new)
        base, same = len(self.data), 0
        self.data += rest
        for i in range(1, len(rest) + 1):
            token = self.merges.last(self.data, base + i, self.last)
            self.last.append(token)
            same = same + 1 if token == old_last[old_end + i] and len(token) <= i else 0
            if same >= self.merges.longest:
                self.last.extend(old_last[old_end + i + 1 :])
                break
        return self

    def tokens(self) -> list[bytes]:
        out, at = [], len(self.data)
        while at:
            out.append(self.last[at])
            at -= len(self.last[at])
        return out[::-1]


#: Characters up to U+00FF on which the two engines differ: separators that are no white space, and numbers that are no digits.
_ODD = re.compile("[\x1c-\x1f²³¹¼½¾]").search


def _for_latin(pattern: str) -> Callable[[str], list[str]] | None:
    """The pattern with classes that the standard library has, right for texts up to U+00FF without odd characters."""
    for ours, theirs in ((r"[^\s\p{L}\p{N}]", r"(?:[^\s\w]|_)"), (r"\p{L}", r"[^\W\d_]"), (r"\p{N}", r"\d")):
        pattern = pattern.replace(ours, theirs)
    return None if "\\p" in pattern else re.compile(pattern).findall


class Remembered:
    """Answers by piece, up to a bound. Pieces that were met again stay, the others make room."""

    def __init__(self, most: int) -> None:
        self.most = most
        self.answers: dict = {}
        self._again: set[str] = set()

    def missing(self, used: set[str]) -> set[str]:
        """The pieces that have no answer yet; those of the others stay."""
        new = used.difference(self.answers)
        met = used - new
        self._again |= met
        if len(self.answers) + len(new) > self.most:
            keep = self._again if len(self._again) <= self.most // 2 else met
            self.answers = {p: self.answers[p] for p in keep}
            self._again = set()
        return new


class Encoder:
    """A rank file and the pattern that cuts text into pieces."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ids = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.tokens = {str(i): token for token, i in self.ids.items()}
        ids = self.ids
        self.merges = Merges(lambda a, b: ids.get(a + b, NEVER), ids)
        self._names = [str(i) for i in ids.values()]
        self._tables = PrefixTables(self.merges, list(ids))
        self._pieces, self._latin = regex.compile(pattern).findall, _for_latin(pattern)
        self._known = Remembered(REMEMBERED)

    def pieces(self, text: str) -> list[str]:
        """The matches of the pattern; texts in Latin letters go to the faster engine of the standard library."""
        if self._latin is not None and _ODD(text) is None:
            try:
                text.encode("latin-1")
                return self._latin(text)
            except UnicodeEncodeError:
                pass
        return self._pieces(text)

    def coded(self, texts: list[str]) -> list[list[tuple[str, bytes]]]:
        """For each text the ids of its pieces, those of a piece joined by blanks, and the bytes that these ids decode to."""
        cut = [self.pieces(t) for t in texts]
        used = set().union(*cut) if cut else set()
        self._learn(sorted([p.encode() for p in self._known.missing(used)]))
        known = self._known.answers
        return [list(map(known.__getitem__, pieces)) for pieces in cut]

    def encode(self, texts: list[str]) -> list[list[str]]:
        """For each text the ids of its pieces, those of a piece joined by blanks."""
        return [[ids for ids, _ in pieces] for pieces in self.coded(texts)]

    def _learn(self, pieces: list[bytes]) -> None:
        """Encode pieces and decode their ids. Short ones have their prefix tables filled side by side; a long one is an
        edit behind the beginning that it shares with the one before, in order."""
        short = [p for p in pieces if len(p) <= SHORT]
        at = 0
        while at < len(short):
            to, size = at, 0
            while to < len(short) and size < TOGETHER:
                size += len(short[to])
                to += 1
            part = short[at:to]
            found, ends = self._tables.encode(part)
            found = found.tolist()
            names, spelled = list(map(self._names.__getitem__, found)), list(map(self._tables.tokens.__getitem__, found))
            begin, answers = 0, self._known.answers
            for piece, end in zip(part, ends.tolist(), strict=True):
                answers[piece.decode()] = (" ".join(names[begin:end]), b"".join(spelled[begin:end]))
                begin = end
            at = to
        table = PrefixTable(self.merges)
        for piece in pieces:
            if len(piece) <= SHORT:
                continue
            shared, limit, old = 0, min(len(piece), len(table.data)), table.data
            while shared < limit and piece[shared] == old[shared]:
                shared += 1
            table.cut(shared).append(piece[shared:])
            ids = " ".join([str(self.ids[t]) for t in table.tokens()])
            self._known.answers[piece.decode()] = (ids, self._bytes(ids))

    def _bytes(self, group: str) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in group.split()])

    def decode(self, groups: list[list[str]]) -> list[bytes]:
        """The bytes of texts given as groups of ids."""
        return [b"".join(map(self._bytes, g)) for g in groups]


def _parts(texts: pa.Array, size: int = 1 << 21) -> Iterator[list[str]]:
    """Texts in lists of about `size` bytes, null as the empty text: bounds the memory of the pieces."""
    for part in slices([pa.record_batch([texts], ["t"])], "t", size):
        yield [t or "" for t in part.column("t").to_pylist()]


@lru_cache(4)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def encoded(text: Column, path: str, pattern: str) -> Column:
    """Ids of a text."""

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = encoder(path, pattern)
        for texts in batches:
            lines = [" ".join(groups) for part in _parts(texts) for groups in coder.encode(part)]
            sizes = [line.count(" ") + 1 if line else 0 for line in lines]
            ids = np.fromstring(" ".join(lines), np.int32, sep=" ") if any(sizes) else np.zeros(0, np.int32)
            yield pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(ids))

    return encode(text)


def decoded(ids: Column, path: str, pattern: str) -> Column:
    """The bytes that ids stand for; null where they are null."""

    @F.arrow_udf("binary")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = encoder(path, pattern)
        for lists in batches:
            texts = coder.decode([[] if x is None else list(map(str, x)) for x in lists.to_pylist()])
            yield pa.array(texts, pa.binary(), mask=lists.is_null().to_numpy(zero_copy_only=False))

    return decode(ids)


def digests(text: Column, path: str, pattern: str) -> Column:
    """Struct of the token count, the digest of the ids and that of the bytes they decode to."""

    @F.arrow_udf("struct<n_tokens: bigint, ids_sha256: string, decoded_sha256: string>")
    def digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = encoder(path, pattern)
        for texts in batches:
            rows: tuple[list, list, list] = ([], [], [])
            for part in _parts(texts):
                coded = coder.coded(part)
                lines = [" ".join([ids for ids, _ in pieces]) for pieces in coded]
                rows[0].extend([line.count(" ") + 1 if line else 0 for line in lines])
                rows[1].extend([hashlib.sha256(line.encode()).hexdigest() for line in lines])
                rows[2].extend([hashlib.sha256(text).hexdigest() for text in (b"".join([t for _, t in pieces]) for pieces in coded)])
            yield pa.StructArray.from_arrays(
                [pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.string()), pa.array(rows[2], pa.string())],
                ["n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return digest(text)


def token_digests(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: its id, token count and digests. Nothing is shuffled."""
    small_batches(docs.sparkSession)
    return docs.select(F.col(id_column), digests(F.col(text_column), path, pattern).alias("__d")).select(id_column, "__d.*")
