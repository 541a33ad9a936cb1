"""Packing of tokenized documents into sequences of one size.

A document longer than a sequence is cut into whole sequences and a rest. All
further decisions are made on the histogram of piece lengths, which has as many
rows as a sequence has tokens, however large the corpus: lengths are placed
longest first, each time into the packs that are shortest so far, and packs of
one kind are a pattern with a count that is split when only some of them take a
piece. The pieces of one length are numbered; a pattern takes runs of these
ranks, and every piece finds its sequence and offset by its own rank.

The tokenizer is one that lowers case, drops white space and merges with word
ends, so that nothing is joined across white space: each different word is
encoded once for as long as a worker remembers it.

Defined results: null is the empty text; a document has its ids and then the end
id, so the empty text is one piece of one id. Rows that are repeated, or that
share an id, are documents of their own. A null id is kept. An empty table gives
no rows. Other columns are not looked at. Which of several pieces of one length
comes first is not defined and does not matter for the padding.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from feedplan.llm.bpe import SHORT
from feedplan.llm.merges import END
from feedplan.llm.prefix_tables import PrefixTables
from feedplan.llm.span_memory import SpanMemory, places
from feedplan.llm.token_counts import CONTRACTIONS, word_end_vocabulary
from feedplan.llm.words import Words, slices, small_batches
from feedplan.operators.lookup import lookup
from feedplan.sources.staging import staged

#: Words whose ids a Python worker remembers: bounds its memory, not the result.
REMEMBERED = 1_000_000
#: Words that are encoded at once.
TOGETHER = 1 << 14
#: Words up to U+00FF without other white space, and without numbers that are no digits: here the two engines agree on all classes.
_LATIN = re.compile("[\x00-\x08\x0e-\x1b\x21-\x7f\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-\xff]+").fullmatch
#: Pieces of such words, and the line feed between two of them.
_PIECES = re.compile(rf"\n|{'|'.join(CONTRACTIONS)}|[^\W\d_]+|\d|(?:[^\s\w]|_)+").findall


class WordIds:
    """Ids of texts, put together from those of their words. Words in Latin letters are encoded side by side by prefix
    tables, all others (and what other white space joins) by the library."""

    def __init__(self, path: str):
        self._library = Tokenizer.from_file(path)
        merges, ids, special = word_end_vocabulary(path)
        self._special = re.compile("|".join(map(re.escape, special)) or "(?!)").search
        self._tables, self._ids = PrefixTables(merges, list(ids)), np.array(list(ids.values()), np.uint32)
        self._memory = SpanMemory(self._learn, [np.uint32], REMEMBERED)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many each text has."""
        words = Words.of(texts)
        ids, sizes = self._memory.columns[0].take(self._memory.find(words.data, words.start, words.end))
        return ids, np.bincount(words.doc, weights=sizes, minlength=len(texts)).astype(np.int64)

    def _learn(self, words: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        texts = [w.decode() for w in words]
        special = self._special
        latin = [len(t) <= SHORT and _LATIN(t) is not None and special(t) is None for t in texts]
        found: list[np.ndarray] = [np.zeros(0, np.uint32)]
        sizes = np.zeros(len(words), np.int64)
        for own, encode in ((True, self._encoded), (False, self._by_library)):
            at = [i for i, x in enumerate(latin) if x == own]
            for begin in range(0, len(at), TOGETHER):
                part = at[begin : begin + TOGETHER]
                ids, sizes[part] = encode([texts[i] for i in part])
                found.append(ids)
        order = np.argsort(~np.array(latin), kind="stable")  # as they were found
        back = np.empty(len(words), np.int64)
        back[order] = np.cumsum(sizes[order]) - sizes[order]
        return [(np.concatenate(found)[places(back, sizes)], sizes)]

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        pieces = _PIECES("\n".join(words).lower() + "\n")
        ends = np.array([i for i, p in enumerate(pieces) if p == "\n"])
        found, stops = self._tables.encode([p.encode() + END for p in pieces if p != "\n"])
        # the pieces up to the end of each word, without a line feed for each word so far
        return self._ids[found], np.diff(np.append(0, stops)[ends - np.arange(len(ends))], prepend=0)

    def _by_library(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [x.ids for x in self._library.encode_batch_fast(words, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes


@lru_cache(4)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


@dataclass(frozen=True)
class Pattern:
    """`count` sequences that hold the same lengths; runs are (length, times)."""

    count: int
    runs: tuple[tuple[int, int], ...]

    def fill(self) -> int:
        return sum(length * times for length, times in self.runs)


def shortest_pack_first(histogram: Mapping[int, int], size: int) -> list[Pattern]:
    """Patterns of packs for a histogram of lengths up to `size`.

    Longest lengths first; a piece goes into the shortest open pack if it fits
    there, else into a new one. Equal packs are handled as one group: a group
    takes as many rounds of a length as it stays the shortest one for.
    """
    open_: list[tuple[int, int, int, tuple]] = []  # (-free, serial, count, runs as a linked list)
    done: list[tuple[int, tuple]] = []
    serial = 0

    def put(free: int, count: int, runs: tuple) -> None:
        nonlocal serial
        serial += 1
        if free:
            heapq.heappush(open_, (-free, serial, count, runs))
        else:
            done.append((count, runs))

    for length in sorted(histogram, reverse=True):
        if not 0 < length <= size:
            raise ValueError(f"a length of {length} does not fit a sequence of {size}")
        left = histogram[length]
        while left:
            if open_ and -open_[0][0] >= length:
                free, _, count, runs = heapq.heappop(open_)
                free = -free
                if left < count:  # only some of the packs take a piece
                    put(free, count - left, runs)
                    count = left
                next_free = -open_[0][0] if open_ else 0
                times = max(1, min(free // length, left // count, (free - next_free) // length))
            else:
                free, runs = size, ()
                times = min(size // length, left)
                count = left // times
            put(free - length * times, count, (runs, length, times))
            left -= count * times
    done += [(count, runs) for _, _, count, runs in open_]
    return [Pattern(count, _runs(runs)) for count, runs in done]


def _runs(linked: tuple) -> tuple[tuple[int, int], ...]:
    out: list[tuple[int, int]] = []
    while linked:
        linked, length, times = linked
        if out and out[-1][0] == length:
            out[-1] = (length, out[-1][1] + times)
        else:
            out.append((length, times))
    return tuple(out[::-1])


def padding(patterns: list[Pattern], size: int) -> int:
    """Tokens of padding: sequences are filled up to their size, except at a power of two."""
    return sum(p.count * (size - p.fill()) for p in patterns if p.fill() & (p.fill() - 1))


@dataclass(frozen=True)
class Slots:
    """Places of all patterns in order of length and rank: for each run of ranks its length, its first rank, the first
    sequence of the pattern, pieces of this length in one sequence, and the offset of the first of them. The number of
    runs depends on the size of a sequence alone, not on the number of documents."""

    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    times: np.ndarray
    offset: np.ndarray

    @classmethod
    def of(cls, patterns: list[Pattern]) -> Slots:
        rows, taken, sequence = [], {}, 0
        for pattern in patterns:
            offset = 0
            for length, times in pattern.runs:
                first = taken.get(length, 0)
                rows.append((length, first, sequence, times, offset))
                taken[length] = first + pattern.count * times
                offset += length * times
            sequence += pattern.count
        return cls(*np.array(sorted(rows), np.int64).reshape(-1, 5).T)

    def __call__(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of each piece."""
        begin, end = np.searchsorted(self.length, length, "left"), np.searchsorted(self.length, length, "right")
        while (wide := end - begin > 1).any():  # halve the runs of the length until the one of the rank is left
            middle = (begin + end) // 2
            below = self.first[np.where(wide, middle, begin)] <= rank
            begin, end = np.where(wide & below, middle, begin), np.where(wide & ~below, middle, end)
        inside = rank - self.first[begin]
        return self.sequence[begin] + inside // self.times[begin], self.offset[begin] + inside % self.times[begin] * length


_PIECE = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def _with(id_type: T.DataType, ddl: str) -> T.StructType:
    return T.StructType([T.StructField("id", id_type), *T.StructType.fromDDL(ddl).fields])


def pieces(docs: DataFrame, path: str, size: int, end_id: int) -> DataFrame:
    """Pieces of documents (id, text), with the task that cut them and their rank among its pieces of the same length."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task, seen = word_ids(path), TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        for part in slices(batches, "text", 1 << 21):
            rows: list[tuple[int, int, int, int, int]] = []
            ids, counts = encode(part.column("text"))
            data, begin = memoryview(ids.astype("<u4").tobytes()), 0
            for doc, n in enumerate(counts.tolist()):
                for start in range(0, n + 1, size):
                    stop = min(start + size, n + 1)
                    code = zlib.crc32(data[4 * (begin + start) : 4 * (begin + min(stop, n))])
                    rows.append((doc, start, stop - start, zlib.crc32(end, code) if stop > n else code, n + 1))
                begin += n
            table = np.array(rows, np.int64)
            length = table[:, 2]
            order = np.argsort(length, kind="stable")
            kinds, first, often = np.unique(length[order], return_index=True, return_counts=True)
            rank = np.empty(len(length), np.int64)
            rank[order] = np.arange(len(length)) + np.repeat(seen[kinds] - first, often)
            seen[kinds] += often
            columns = [part.column("id").take(pa.array(table[:, 0])), *(pa.array(table[:, i]) for i in range(1, 5))]
            yield pa.record_batch([*columns, pa.array(np.full(len(length), task)), pa.array(rank)], ["id", "start", "length", "ids_crc32", "doc_tokens", "task", "rank"])

    return docs.select("id", "text").mapInArrow(cut, _with(docs.schema["id"].dataType, f"{_PIECE}, task bigint, rank bigint"))


def packed(docs: DataFrame, path: str, size: int = 4096, end_id: int = 2, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per piece: where it lies in its document, and in which sequence at which offset."""
    spark = docs.sparkSession
    small_batches(spark)
    named = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    cut = staged(pieces(named, path, size, end_id), "pieces")
    counts = staged(cut.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    # at most `size` rows: all that the driver sees of the corpus
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = spark.sparkContext.broadcast(Slots.of(shortest_pack_first(histogram, size)))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    # tasks and lengths are counted by many small groups; a frequent length is spread over all of them
    ranked = lookup(cut, starts, {"task": "task", "length": "length"}, "rank").withColumn("rank", F.col("rank") + F.col("before")).drop("task", "before")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = slots.value(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
                names = ["id", *(c.split()[0] for c in _PIECE.split(", "))]
                yield pa.record_batch([batch.column(c) for c in names] + [pa.array(x) for x in found], [*names, "sequence_id", "offset"])

    placed = ranked.mapInArrow(place, _with(docs.schema[id_column].dataType, f"{_PIECE}, sequence_id bigint, offset bigint"))
    return placed.withColumnRenamed("id", id_column)
