"""Token counts by finite-state transducers.

Two deterministic transducers are compiled from the tokenizer file. The first
reads characters and marks where pieces of text begin: it has a handful of
states, so its effect on any chunk of text is a small map from entry state to
exit state. All chunks of a batch are run side by side for every entry state,
the maps are composed by a parallel prefix scan, and a second run from the now
known entry states emits the marks. The second transducer reads the bytes of a
piece; its states are the prefixes met so far, compiled when first met, and the
transition that ends a piece is annotated with the number of tokens emitted.

Built for tokenizers of this kind: NFC, runs of white space to one blank, lower
case; contractions, runs of letters, single digits and runs of other characters
as pieces; merges with an end-of-word suffix. Added special tokens inside a text
count one each and part the text around them, as the library does by default.

Defined results: null is the empty text; empty and blank texts have no tokens.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedplan.llm.words import small_batches

from feedplan.llm.bpe import Remembered
from feedplan.llm.merges import END, NEVER, Merges

#: States and pieces that a Python worker keeps compiled: bounds its memory, not the result.
COMPILED = 500_000
CHUNK = 512

# Character classes, and the code points of Unicode's White_Space.
SPACE, LETTER, DIGIT, OTHER, QUOTE, C_STMD, C_R, C_V, C_L, C_E = range(10)
WHITE = (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
# States: outside any piece, in a run of letters, after a digit, in a run of others, after a contraction, and
# after a quote that may begin a contraction, alone or with r, v or l.
OUT, IN_LETTERS, IN_DIGIT, IN_OTHER, SHORT, Q, Q_R, Q_V, Q_L = range(9)
STATES, CLASSES = 9, 10


def _compile_marks() -> tuple[np.ndarray, np.ndarray]:
    """Transition table, and marks: bit 0, a piece begins at this character; bit 1, one began a character before;
    bit 2, this character is in a piece."""
    to, mark = np.zeros((STATES, CLASSES), np.uint8), np.zeros((STATES, CLASSES), np.uint8)
    plain = {SPACE: (OUT, 0), DIGIT: (IN_DIGIT, 5), OTHER: (IN_OTHER, 5), QUOTE: (Q, 5)}
    for state in range(STATES):
        for kind in range(CLASSES):
            letter = kind in (LETTER, C_STMD, C_R, C_V, C_L, C_E)
            goes, emits = plain.get(kind, (IN_LETTERS, 5))
            if state == IN_LETTERS and letter:
                goes, emits = IN_LETTERS, 4
            elif state in (IN_OTHER, Q) and kind in (OTHER, QUOTE):
                goes, emits = IN_OTHER, 4
            elif state == Q and kind in (C_STMD, C_R, C_V, C_L):
                # one letter may end the contraction, or two may; a mark for the second case comes a character later
                goes, emits = {C_STMD: SHORT, C_R: Q_R, C_V: Q_V, C_L: Q_L}[kind], 4
            elif (state, kind) in ((Q_R, C_E), (Q_V, C_E), (Q_L, C_L)):
                goes, emits = SHORT, 4
            elif state in (Q_R, Q_V, Q_L):
                # no contraction: the letter after the quote began a run of letters
                goes, emits = (IN_LETTERS, 4 | 2) if letter else (goes, emits | 2)
            to[state, kind], mark[state, kind] = goes, emits
    return to, mark


@lru_cache(1)
def _classes() -> np.ndarray:
    out = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, range(0x110000)))
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", DIGIT)):
        for run in regex.finditer(pattern, every):
            out[run.start() : run.end()] = kind
    out[list(WHITE)] = SPACE
    for letters, kind in (("'", QUOTE), ("stmd", C_STMD), ("r", C_R), ("v", C_V), ("l", C_L), ("e", C_E)):
        out[[ord(x) for x in letters]] = kind
    return out


def compose(maps: np.ndarray) -> np.ndarray:
    """Inclusive prefix scan: row i is the effect of the first i + 1 maps, one after the other."""
    maps, step = maps.copy(), 1
    while step < len(maps):
        maps[step:] = np.take_along_axis(maps[step:], maps[:-step].astype(np.int64), 1)
        step *= 2
    return maps


class PieceMarks:
    """The first transducer."""

    def __init__(self) -> None:
        to, mark = _compile_marks()
        self.to, self.mark, self.classes = to.ravel(), mark.ravel(), _classes()

    def __call__(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First character and end of each piece."""
        n = len(points)
        rows = -(-n // CHUNK)
        kinds = np.zeros(rows * CHUNK, np.uint8)  # filled up with white space
        kinds[:n] = self.classes[points]
        kinds = np.ascontiguousarray(kinds.reshape(rows, CHUNK).T)
        states = np.repeat(np.arange(STATES, dtype=np.uint8)[None, :], rows, 0)
        for at in kinds:
            states = self.to.take(states * np.uint8(CLASSES) + at[:, None])
        entry = np.full(rows, OUT, np.uint8)
        entry[1:] = compose(states)[:-1, OUT]
        marks = np.empty_like(kinds)
        state = entry
        for i, at in enumerate(kinds):
            key = state * np.uint8(CLASSES) + at
            marks[i] = self.mark.take(key)
            state = self.to.take(key)
        marks = marks.T.ravel()
        begins = marks & 1 > 0
        begins[:-1] |= marks[1:] & 2 > 0
        start = np.flatnonzero(begins)
        inside = marks & 4 > 0
        ends = begins.copy()
        ends[1:] |= inside[:-1] & ~inside[1:]
        ends[0] = False
        at = np.append(np.flatnonzero(ends), len(marks))
        return start, at[np.searchsorted(at, start, "right")]


class PieceCounts:
    """The second transducer: `arc` has the transitions, `emits` the tokens of a piece that ends in a state."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.known = Remembered(COMPILED)
        self._reset()

    def _reset(self) -> None:
        self.arc: dict[int, int] = {}
        self.emits = [0]  # -1: not compiled yet
        self.counts = [0]  # tokens of the prefix itself, when the piece goes on; -1: not compiled yet

    def compile(self, pieces: list[bytes]) -> list[int]:
        """Tokens of each piece. In sorted order a piece goes on from the states it shares with the one before."""
        arc, emits, counts, merges = self.arc, self.emits, self.counts, self.merges
        out, before = [], b""
        path, last = [0], [b""]  # states along the piece, and last tokens of as many of its prefixes as were needed
        for data in pieces:
            shared, limit = 0, min(len(data), len(before))
            while shared < limit and data[shared] == before[shared]:
                shared += 1
            del path[shared + 1 :], last[shared + 1 :]
            before = data
            for byte in data[shared:]:
                key = path[-1] << 8 | byte
                to = arc.get(key)
                if to is None:
                    to = arc[key] = len(emits)
                    emits.append(-1)
                    counts.append(-1)
                path.append(to)
            state = path[-1]
            if emits[state] < 0:
                end = len(data)
                merges.extend(data[: end - 1], len(last) - 1, last)
                for at in range(1, end):
                    if counts[path[at]] < 0:
                        counts[path[at]] = counts[path[at - len(last[at])]] + 1
                final = merges.last(data, end, last, END)
                emits[state] = counts[path[end - (len(final) - 1)]] + 1
            out.append(emits[state])
        return out

    def __call__(self, pieces: list[str]) -> list[int]:
        if len(self.emits) > COMPILED:
            self._reset()
        ordered = sorted([p.encode() for p in self.known.missing(set(pieces))])
        known = self.known.answers
        known.update(zip([p.decode() for p in ordered], self.compile(ordered), strict=True))
        return list(map(known.__getitem__, pieces))


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files: printable ones for themselves, the rest from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def word_end_vocabulary(path: str) -> tuple[Merges, dict[bytes, int], list[str]]:
    """Merges, ids and special tokens of a tokenizer file with word ends."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model = spec["model"]
    suffix = model["end_of_word_suffix"]
    letters = _byte_letters()

    def token(text: str) -> bytes:
        ended = text.endswith(suffix)
        return bytes(letters[c] for c in (text[: -len(suffix)] if ended else text)) + END * ended

    special = {t["content"] for t in spec["added_tokens"]}
    known = {token(t): i for t, i in model["vocab"].items() if t not in special}
    ranks: dict[tuple[bytes, bytes], int] = {}
    for i, pair in enumerate(model["merges"]):
        a, b = pair if isinstance(pair, list) else pair.split(" ")
        ranks[token(a), token(b)] = i
    return Merges(lambda a, b: ranks.get((a, b), NEVER), known), known, sorted(special)


class Counter:
    """Token counts of whole texts for one tokenizer file."""

    def __init__(self, path: str):
        merges, _, self.special = word_end_vocabulary(path)
        self.marks = PieceMarks()
        self.pieces = PieceCounts(merges)

    def __call__(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        out = np.zeros(len(texts), np.int64)
        plain = []
        for i, text in enumerate(texts):
            for mark in self.special:
                if mark in text:
                    out[i] += text.count(mark)
                    text = text.replace(mark, " ")
            if not text.isascii():
                text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
            plain.append(text.lower())
        joined = "\n".join(plain)
        sizes = np.array([len(t) + 1 for t in plain], np.int64)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        if not len(points):
            return out
        start, end = self.marks(points)
        tokens = np.array(self.pieces([joined[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]), np.int64)
        doc = np.searchsorted(np.cumsum(sizes), start, "right")
        return out + np.bincount(doc, weights=tokens, minlength=len(texts)).astype(np.int64)


@lru_cache(4)
def counter(path: str) -> Counter:
    return Counter(path)


def token_count(text: Column, path: str) -> Column:
    """Tokens of a text."""

    @F.arrow_udf("bigint")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        count_all = counter(path)
        for texts in batches:
            out, part, size = [], [], 0
            for text_ in texts:
                part.append(text_.as_py() or "")
                size += len(part[-1])
                if size >= 1 << 21:
                    out.append(count_all(part))
                    part, size = [], 0
            out.append(count_all(part))
            yield pa.array(np.concatenate(out), pa.int64())

    return count(text)


def token_counts(docs: DataFrame, path: str, limit: int = 2048, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document. Nothing is shuffled."""
    small_batches(docs.sparkSession)
    text = F.col(text_column)
    counted = docs.select(id_column, F.coalesce(F.octet_length(text).cast("bigint"), F.lit(0).cast("bigint")).alias("n_bytes"), token_count(text, path).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
