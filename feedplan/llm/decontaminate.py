"""Benchmark decontamination: short test items inside long documents.

Containment is the share of an item's distinct word shingles that a document
has. Items are partitioned by their number of shingles. Each partition has a
sketch size: the smallest hashed shingles (MinHash, one permutation) that a
document is probed for. An item with n shingles that is contained with
threshold t misses floor((1 - t) n) of them at most, so one shingle more than
that always meets; large partitions take so many that all of them miss with a
chance under `miss` only. Documents that meet a sketch are verified by their
exact shingle containment.

The index of the items is broadcast only when their texts, counted first, have
no more characters than `index_limit`, with `ITEM_COST` more for each item (two
characters make one shingle of 16 bytes at most); larger benchmarks, of few long
items or of many short ones, meet the documents by shuffle joins on the sketched
shingles. Both ways take the same sketches.

Defined results: null, empty and blank texts hold nothing and are held by
nothing; a text of fewer words than a shingle has one shingle of all of them;
repeated items are reported each; an empty benchmark leaks nowhere.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedplan.llm.shingles import distinct, shingles
from feedplan.llm.words import mix, seeded, slices, small_batches
from feedplan.operators.lookup import lookup

SHINGLE = 5
THRESHOLD = 0.8
#: Characters of item texts that a broadcast index may be made of.
INDEX_LIMIT = 8_000_000
#: Characters that an item counts for beside its text: bounds the rows of the index.
ITEM_COST = 64
MISS = 1e-9
_SKETCH_SEED = 10


def sketch_size(n: int, threshold: float, miss: float) -> int:
    """Shingles to probe for, for an item of n shingles; one value for each partition by size (powers of two)."""
    upper = 1 << max(n - 1, 0).bit_length()
    sure = math.floor((1 - threshold) * upper + 1e-9) + 1
    likely = math.ceil(math.log(miss) / math.log(1 - threshold)) if threshold < 1 else 1
    return min(n, sure, likely)


def needed(n: np.ndarray, threshold: float) -> np.ndarray:
    """Shared shingles from which an item of n shingles is contained."""
    return np.ceil(n * threshold - 1e-9).astype(np.int64)


def sketched(value: np.ndarray, doc: np.ndarray, n: np.ndarray, threshold: float, miss: float) -> np.ndarray:
    """Whether each shingle of sets (in order of `doc`, with `n` shingles each) is in the sketch of its set."""
    order = np.lexsort((seeded(value, _SKETCH_SEED), doc))
    rank = np.empty(len(doc), np.int64)
    rank[order] = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    kinds, which = np.unique(n, return_inverse=True)
    limit = np.array([sketch_size(int(k), threshold, miss) if k else 0 for k in kinds], np.int64)[which]
    return rank < np.repeat(limit, n)


class Index:
    """Items by shingle: `at` sorted shingles, `item` the ordinal of the item of each; sketched ones apart."""

    def __init__(self, texts: pa.Array, size: int, threshold: float, miss: float):
        value, doc = distinct(*shingles(texts, size))
        self.n = np.bincount(doc, minlength=len(texts))
        probes = sketched(value, doc, self.n, threshold, miss)
        self.least = needed(self.n, threshold)
        self.shingle, self.item = self._sorted(value, doc)
        self.probe, self.probe_item = self._sorted(value[probes], doc[probes])
        self.maybe = np.zeros(1 << 18, bool)
        self.maybe[(mix(self.probe) & np.uint64((1 << 18) - 1)).astype(np.int64)] = True

    @staticmethod
    def _sorted(value: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(value, kind="stable")
        return value[order], item[order]

    @staticmethod
    def _meet(keys: np.ndarray, items: np.ndarray, value: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, item) for each value of a text that is one of the keys of an item."""
        low = np.searchsorted(keys, value, "left")
        n = np.searchsorted(keys, value, "right") - low
        hit = n > 0
        low, n, doc = low[hit], n[hit], doc[hit]
        at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return np.repeat(doc, n), items[at]

    def leaks(self, texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, item and shared shingles of each leak, in this order."""
        value, doc = shingles(texts, size)
        probed = self.maybe[(mix(value) & np.uint64((1 << 18) - 1)).astype(np.int64)]
        d, i = self._meet(self.probe, self.probe_item, value[probed], doc[probed])
        width = np.int64(max(len(self.n), 1))
        candidates = np.unique(d * width + i)
        if not len(candidates):
            return candidates, candidates, candidates
        held = np.zeros(len(texts), bool)
        held[candidates // width] = True
        value, doc = distinct(value[held[doc]], doc[held[doc]])
        d, i = self._meet(self.shingle, self.item, value, doc)
        pairs, shared = np.unique(d * width + i, return_counts=True)
        keep = np.isin(pairs, candidates) & (shared >= self.least[pairs % width])
        return pairs[keep] // width, pairs[keep] % width, shared[keep]


def _by_broadcast(spark: SparkSession, text: Column, rows: list, size: int, threshold: float, miss: float) -> Column:
    index = Index(pa.array([r["__text"] for r in rows], pa.large_string()), size, threshold, miss)
    shared_index = spark.sparkContext.broadcast((index, np.array([r["__item"] for r in rows])))

    @F.arrow_udf("array<struct<item_id: bigint, n_shared: bigint, n_shingles: bigint>>")
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index, ids = shared_index.value
        for texts in batches:
            out = []
            for part in slices([pa.record_batch([texts], ["t"])], "t"):
                doc, item, shared = index.leaks(part.column("t"), size)
                n = np.bincount(doc, minlength=part.num_rows)
                struct = pa.StructArray.from_arrays(
                    [pa.array(ids[item].astype(np.int64)), pa.array(shared.astype(np.int64)), pa.array(index.n[item].astype(np.int64))],
                    ["item_id", "n_shared", "n_shingles"],
                )
                out.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), struct))
            yield pa.concat_arrays(out) if out else pa.array([], search_type())

    return search(text)


def search_type() -> pa.DataType:
    return pa.list_(pa.struct([("item_id", pa.int64()), ("n_shared", pa.int64()), ("n_shingles", pa.int64())]))


def _sets(keyed: DataFrame, key: str, size: int) -> DataFrame:
    """(key, shingle) for each distinct shingle of each row of (key, text)."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "__text"):
            value, doc = distinct(*shingles(part.column("__text"), size))
            yield pa.record_batch([part.column(key).take(pa.array(doc)), pa.array(value.view(np.int64))], [key, "shingle"])

    return keyed.mapInArrow(explode, f"{key} {keyed.schema[key].dataType.simpleString()}, shingle bigint")


def _item_sets(keyed: DataFrame, size: int, threshold: float, miss: float) -> DataFrame:
    """(own, shingle, n_shingles, probe) for each distinct shingle of each item: one task has all of an item."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "__text"):
            value, doc = distinct(*shingles(part.column("__text"), size))
            n = np.bincount(doc, minlength=part.num_rows)
            probe = sketched(value, doc, n, threshold, miss)
            columns = [part.column("__own").take(pa.array(doc)), pa.array(value.view(np.int64)), pa.array(n[doc].astype(np.int64)), pa.array(probe)]
            yield pa.record_batch(columns, ["__own", "shingle", "n_shingles", "probe"])

    return keyed.mapInArrow(explode, "__own string, shingle bigint, n_shingles bigint, probe boolean")


def _by_joins(docs: DataFrame, text: Column, items: DataFrame, size: int, threshold: float, miss: float, column: str) -> DataFrame:
    """Any number of items: texts are keyed by digest, so equal texts are searched once. An item is keyed by its id and
    text; its repeated rows are searched once and reported each."""
    key = F.sha2(text, 256)
    own = F.sha2(F.concat_ws(":", "__item", "__text"), 256)
    rows = items.groupBy(own.alias("__own"), F.col("__item").alias("item_id")).agg(F.count(F.lit(1)).cast("int").alias("times"))
    theirs = _item_sets(items.dropDuplicates().select(own.alias("__own"), "__text"), size, threshold, miss)
    probes = theirs.where("probe").select("__own", "shingle")
    ours = _sets(docs.select(key.alias("__key"), text.alias("__text")).where(text.isNotNull()), "__key", size)
    candidates = ours.join(probes, "shingle").select("__key", "__own").distinct()
    held = ours.join(candidates.select("__key").distinct(), "__key", "left_semi").distinct()
    shared = (
        held.join(theirs.drop("probe"), "shingle")
        .join(candidates, ["__key", "__own"], "left_semi")
        .groupBy("__key", "__own")
        .agg(F.count(F.lit(1)).alias("n_shared"), F.first("n_shingles").alias("n_shingles"))
        .where(F.col("n_shared") >= F.ceil(F.col("n_shingles") * threshold - 1e-9))
        .join(rows, "__own")
    )
    each = F.array_repeat(F.struct("item_id", "n_shared", "n_shingles"), F.col("times"))
    lists = shared.groupBy("__key").agg(F.sort_array(F.flatten(F.collect_list(each))).alias(column))
    none = F.expr("cast(array() as array<struct<item_id: bigint, n_shared: bigint, n_shingles: bigint>>)")
    asked = docs.withColumns({"__key": key, "__row": F.monotonically_increasing_id()})  # the row only spreads what has no key
    found = lookup(asked, lists, {"__key": "__key"}, "__row").drop("__key", "__row")
    return found.withColumn(column, F.coalesce(column, none))


def with_leaks(
    docs: DataFrame,
    items: DataFrame,
    text_column: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    size: int = SHINGLE,
    threshold: float = THRESHOLD,
    miss: float = MISS,
    index_limit: int = INDEX_LIMIT,
    column: str = "leaks",
) -> DataFrame:
    """The documents with a list of the items that each contains, with shared and all shingles of the item."""
    small_batches(docs.sparkSession)
    theirs = items.select(F.col(item_id).cast("bigint").alias("__item"), F.col(item_text).alias("__text"))
    # an item without a word is held by nothing
    theirs = theirs.where(F.col("__item").isNotNull() & F.col("__text").rlike(r"[^\x20\x09-\x0D]"))
    sizes = theirs.agg(F.coalesce(F.sum(F.length("__text") + ITEM_COST), F.lit(0))).first()
    if sizes[0] <= index_limit:
        return docs.withColumn(column, _by_broadcast(docs.sparkSession, F.col(text_column), theirs.collect(), size, threshold, miss))
    return _by_joins(docs, F.col(text_column), theirs, size, threshold, miss, column)


def leaks(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", **options: object) -> DataFrame:
    """One row for each document and item that it contains."""
    text: str = options.get("text_column", "text")  # type: ignore[assignment]
    found = with_leaks(docs.select(id_column, text), items, column="__leaks", **options)  # type: ignore[arg-type]
    return (
        found.select(id_column, F.explode_outer("__leaks").alias("__l"))
        .where("__l is not null")
        .select(id_column, "__l.*")
        .withColumn("containment", F.col("n_shared") / F.col("n_shingles"))
    )
