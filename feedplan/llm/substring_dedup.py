"""Removal of word windows that occur again, by FM-indexes of content shards.

Shards are made by content, so that no document has to meet every shard: each
window of `width` words has an anchor, the run of `ANCHOR` words in it with the
least hash. Equal windows have equal anchors, so all occurrences of a window
meet in the shard of its anchor. The consecutive windows of a document with the
same anchor form one unit of text. Only units whose anchor occurs in two
different texts or twice in one are shipped; a bitmap of fixed size tells most
of the others apart (a false hit costs a shipped unit, nothing else). Anchors
that very many documents share are parted further: each of their windows has a
shard of its own, which all equal windows share and no other. Units that are
equal word by word are sent once per batch, with a weight.

Each shard is an FM-index (wavelet matrix over the words of its units). Its
units are streamed against it: backward search gives matching statistics, and
windows inside intervals of a total weight of two are reported. Texts that occur
as a whole in several rows have a multiplicity, and repeat in all their windows.

Defined results: null, empty and blank texts have no words, and their kept text
is empty; equal rows give equal results; a text shorter than a window loses
nothing; nulls in the id are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedplan.llm.bitmaps import bitmap, held
from feedplan.llm.fm_index import FMIndex
from feedplan.llm.groups import whole_groups
from feedplan.llm.words import Words, grams, mix, slices, small_batches
from feedplan.operators.lookup import lookup

WIDTH = 35
ANCHOR = 8
#: Bits of the bitmaps of anchors that occur again, and of those in more than HOT texts: fixed sizes.
BITS, HOT_BITS = 27, 22
HOT = 1_000
#: Bytes of text of one index: bounds the memory of a task.
SHARD_BYTES = 2_400_000


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the (first) least value among `width` values from each place."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    place, size = np.arange(len(values)), 1
    while size < width:
        step = min(size, width - size)
        a, b = place[:-step], place[step:]
        place = np.where(values[b] < values[a], b, a)
        size += step
    return place[:n]


class Units:
    """Runs of windows with one anchor, over a batch of texts."""

    def __init__(self, texts: pa.Array, width: int):
        self.words, self.width = Words.of(texts), width
        hashes = self.words.hashes()
        doc = self.words.doc
        inside = doc[: max(len(hashes) - width + 1, 0)] == doc[width - 1 :]
        self.heads = grams(hashes, ANCHOR)
        place = _least(self.heads, width - ANCHOR + 1)
        starts = np.flatnonzero(inside)
        place = place[starts]
        new = np.ones(len(starts), bool)
        new[1:] = (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)
        last = np.ones(len(starts), bool)
        last[:-1] = new[1:]
        self.first, self.last = starts[new], starts[last]
        self.doc = doc[self.first]
        self.anchor = self.heads[place[new]]
        self._whole = grams(hashes, width)
        counts = self.words.counts()
        self.doc_first = np.cumsum(counts) - counts

    def select(self, keep: np.ndarray) -> Units:
        self.first, self.last, self.doc, self.anchor = self.first[keep], self.last[keep], self.doc[keep], self.anchor[keep]
        return self

    def part(self, hot: np.ndarray) -> Units:
        """Hot units fall apart into their windows, each distinct one with a shard of its own."""
        n = np.where(hot, self.last - self.first + 1, 1)
        offset = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        many = np.repeat(hot, n)
        self.anchor, self.doc = np.repeat(self.anchor, n), np.repeat(self.doc, n)
        first = np.repeat(self.first, n) + offset
        self.last = np.where(many, first, np.repeat(self.last, n))
        self.first = first
        self.anchor = np.where(many, mix(self.anchor ^ (self._whole[first] >> np.uint64(1))), self.anchor)
        return self

    def ids(self) -> np.ndarray:
        """Hash of the words of each unit: its first and last window overlap and cover it."""
        size = (self.last - self.first).astype(np.uint64)
        return mix(self._whole[self.first] + mix(self._whole[self.last] + size))

    def texts(self) -> pa.Array:
        start, end = self.words.start[self.first], self.words.end[self.last + self.width - 1]
        size = end - start
        bounds = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        data = self.words.data[np.arange(int(bounds[-1])) + np.repeat(start - bounds[:-1], size)]
        return pa.StringArray.from_buffers(len(size), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data)))


def _keyed(docs: DataFrame, text_column: str) -> DataFrame:
    text = F.coalesce(F.col(text_column), F.lit(""))
    return docs.withColumns({"__k1": F.xxhash64(text), "__k2": F.xxhash64(F.lit(2), text)})


def _anchors(keyed: DataFrame, text_column: str, width: int) -> DataFrame:
    """(anchor, k1, twice) for each distinct anchor of each text."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_column):
            units = Units(part.column(text_column), width)
            order = np.lexsort((units.anchor, units.doc))
            value, doc = units.anchor[order], units.doc[order]
            new = np.ones(len(value) + 1, bool)
            new[1:-1] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
            first = np.flatnonzero(new[:-1])
            twice = np.diff(np.append(first, len(value))) > 1
            yield pa.record_batch(
                [pa.array(value[first].view(np.int64)), part.column("__k1").take(pa.array(doc[first])), pa.array(twice.astype(np.int32))],
                ["anchor", "k1", "twice"],
            )

    return keyed.select("__k1", text_column).mapInArrow(emit, "anchor bigint, k1 bigint, twice int")


def repeated_runs(docs: DataFrame, text_column: str = "text", width: int = WIDTH) -> DataFrame:
    """(k1, k2, runs): runs of the starts of windows that occur again, by key of the text."""
    spark = docs.sparkSession
    keyed = _keyed(docs.select(text_column), text_column)
    seen = _anchors(keyed, text_column, width).groupBy("anchor")
    seen = seen.agg(F.min("k1").alias("a"), F.max("k1").alias("b"), F.max("twice").alias("twice"), F.count(F.lit(1)).alias("n"))
    again = seen.where((F.col("a") != F.col("b")) | (F.col("twice") > 0)).select("anchor", "n")
    again = again.persist()
    known = spark.sparkContext.broadcast((bitmap(again, "anchor", BITS), bitmap(again.where(F.col("n") > HOT), "anchor", HOT_BITS)))
    again.unpersist()

    def cut(part: pa.RecordBatch) -> Units:
        repeated, hot = known.value
        units = Units(part.column(text_column), width)
        units.select(held(repeated, units.anchor, BITS))
        return units.part(held(hot, units.anchor, HOT_BITS))

    def ship(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_column):
            units = cut(part)
            ids = units.ids()
            _, one, weight = np.unique(ids, return_index=True, return_counts=True)
            units.select(one)
            yield pa.record_batch(
                [pa.array(units.anchor.view(np.int64)), pa.array(ids[one].view(np.int64)), pa.array(weight.astype(np.int32)), units.texts()],
                ["shard", "unit", "weight", "words"],
            )

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_column):
            units = cut(part)
            doc = pa.array(units.doc)
            yield pa.record_batch(
                [
                    pa.array(units.anchor.view(np.int64)),
                    pa.array(units.ids().view(np.int64)),
                    part.column("__k1").take(doc),
                    part.column("__k2").take(doc),
                    pa.array((units.first - units.doc_first[units.doc]).astype(np.int32)),
                ],
                ["shard", "unit", "k1", "k2", "start"],
            )

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in whole_groups(_collapsed(batches), "shard", SHARD_BYTES, "words"):
            yield _search(shard, width)

    shipped = keyed.select(text_column).mapInArrow(ship, "shard bigint, unit bigint, weight int, words string")
    verdicts = shipped.repartition("shard").sortWithinPartitions("shard", "unit").mapInArrow(index, "shard bigint, unit bigint, hits array<int>")
    occurrences = keyed.mapInArrow(places, "shard bigint, unit bigint, k1 bigint, k2 bigint, start int")
    return (
        occurrences.join(verdicts, ["shard", "unit"])
        .groupBy("k1", "k2")
        .agg(F.collect_set(F.struct("start", "hits")).alias("runs"))
    )


def _collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of shard and unit; equal ones of a batch are one row with the sum of their weights."""
    for batch in batches:
        if not batch.num_rows:
            continue
        shard, unit, weight = (batch.column(c).to_numpy() for c in ("shard", "unit", "weight"))
        new = np.append(True, (shard[1:] != shard[:-1]) | (unit[1:] != unit[:-1]))
        first = np.flatnonzero(new)
        rows = batch.take(pa.array(first)) if len(first) < len(new) else batch
        weight = pa.array(np.add.reduceat(weight.astype(np.int64), first))
        yield pa.record_batch([rows.column("shard"), rows.column("unit"), weight, rows.column("words")], ["shard", "unit", "weight", "words"])


def _search(shard: pa.Table, width: int) -> pa.RecordBatch:
    """Units with windows that occur again: runs of their starts, first and last in turn."""
    unit = shard["unit"].to_numpy()
    _, one, which = np.unique(unit, return_index=True, return_inverse=True)
    weight = np.bincount(which, weights=shard["weight"].to_numpy()).astype(np.int64)
    words = Words.of(shard["words"].take(pa.array(one)))
    found = FMIndex(words.hashes(), words.counts(), weight).repeated_windows(width)
    at, first, last = (np.concatenate([x[i] for x in found]) if found else np.zeros(0, np.int64) for i in range(3))
    order = np.argsort(at, kind="stable")
    at, first, last = at[order], first[order], last[order]
    units, n = np.unique(at, return_counts=True)
    hits = pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], 2 * np.cumsum(n)]).astype(np.int32)), pa.array(np.stack([first, last], 1).ravel().astype(np.int32))
    )
    rows = one[units]
    return pa.record_batch([shard["shard"].combine_chunks().take(pa.array(rows)), pa.array(unit[rows]), hits], ["shard", "unit", "hits"])


def removed_words(n: int, runs: list[tuple[int, list[int]]] | None, copies: int, width: int) -> np.ndarray:
    """Which of the n words of a text are in a window that occurs again."""
    gone = np.zeros(n + 1, np.int64)
    if copies > 1 and n >= width:
        return np.ones(n, bool)
    for start, hits in runs or ():
        for first, last in zip(hits[::2], hits[1::2], strict=True):
            gone[start + first] += 1
            gone[start + last + width] -= 1
    return np.cumsum(gone)[:-1] > 0


def deduplicated(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = WIDTH) -> DataFrame:
    """One row per document: its words, how many are removed, and the digest of the kept text."""
    small_batches(docs.sparkSession)
    keyed = _keyed(docs.select(id_column, text_column), text_column)
    copies = keyed.groupBy("__k1", "__k2").agg(F.count(F.lit(1)).alias("__copies")).where("__copies > 1")
    runs = repeated_runs(docs, text_column, width).select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2"), F.col("runs").alias("__runs"))
    marks = runs.join(copies, ["__k1", "__k2"], "full").hint("shuffle_hash")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: tuple[list, list, list] = ([], [], [])
            for text, found, n_copies in zip(batch.column(text_column), batch.column("__runs"), batch.column("__copies"), strict=True):
                words = (text.as_py() or "").encode().split()
                marked = [(r["start"], r["hits"]) for r in found.as_py() or ()]
                gone = removed_words(len(words), marked, n_copies.as_py() or 1, width)
                rows[0].append(len(words))
                rows[1].append(int(gone.sum()))
                rows[2].append(hashlib.sha256(b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])).hexdigest())
            yield pa.record_batch(
                [batch.column(id_column), pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.string())],
                [id_column, "n_words", "n_removed", "kept_sha256"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    # very many rows may have one text: the lookup lets them be split over tasks
    marked = lookup(keyed, marks, {"__k1": "__k1", "__k2": "__k2"}, id_column)
    return marked.mapInArrow(finish, f"{id_column} {kind}, n_words bigint, n_removed bigint, kept_sha256 string")
