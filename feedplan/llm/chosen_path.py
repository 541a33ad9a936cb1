"""Similarity self-join of documents on word shingles by chosen paths.

Sets of shingles are split recursively. At each node of a tree a set goes down
the branches of a few of its shingles: those whose hash, drawn anew for every
run and level, is under a bound inverse to the size of the set. Similar sets
choose shared shingles together, others hardly ever. A branch with one set ends;
a small one is compared pair by pair on sketches; a larger one is split again;
what is still large after the last level is taken for similar. Runs are repeated
until a pair at the threshold is missed with a chance under 1 - recall.

Compared pairs give candidate groups (connected components). Inside a group all
pairs are then verified by their exact Jaccard similarity, in blocks of bounded
size, so that a huge group is spread over many tasks. Pairs are counted there
and never written out. Copies (equal sets) are one set with a multiplicity.

Result: one row per row of the input, with the least id of the group of
documents that are connected by links of at least the threshold, and the number
of links, copies included.

Defined results: a text of fewer words than a shingle has one shingle of all of
them; null, empty and blank texts have no links and are groups of their own;
rows that repeat an id are one document; a null id is linked like any other
and its group has the least id that is not null.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedplan.llm.bitmaps import bitmap, held
from feedplan.llm.components import components
from feedplan.llm.groups import whole_groups
from feedplan.llm.shingles import distinct, shingles
from feedplan.llm.shingles import sets as sets_of
from feedplan.llm.words import mix, seeded, slices, small_batches
from feedplan.operators.lookup import lookup, salts_of
from feedplan.sources.staging import staged

#: Bits of the filter on documents to verify: a fixed size.
BITS = 26
_CODE = 0xFF


@dataclass(frozen=True)
class Paths:
    """Shingle size, threshold, recall of a pair at the threshold; expected branches of a set at the first level,
    levels, sets of a bucket that is compared, bins of a sketch; sets, and shingles, of a block that is verified."""

    shingle: int = 5
    threshold: float = 0.8
    recall: float = 0.999
    branches: float = 2.0
    levels: int = 3
    bucket: int = 128
    bins: int = 64
    block: int = 256
    block_shingles: int = 2_000_000

    def chosen(self, level: int) -> float:
        """Expected branches of a set: after the first level just enough for a pair at the threshold to share one."""
        return self.branches if level == 0 else 1 / self.threshold

    def runs(self) -> int:
        """Runs until the recall: a pair at the threshold shares a Poisson number of choices at each level. All branches
        of a run go on by the same choices, so it is found by a run only if it shares one at every level."""
        found = 1.0
        for level in range(self.levels):
            found *= 1 - math.exp(-self.chosen(level) * self.threshold)
        runs = math.ceil(math.log(1 - self.recall) / math.log(1 - found))
        if runs > 31 or self.levels > 7:
            raise ValueError("more runs or levels than a code has room for")
        return runs


def _choices(value: np.ndarray, size: np.ndarray, paths: Paths, level: int, run: int) -> np.ndarray:
    """Places of the shingles that their sets choose in this run at this level; size: that of the set of each."""
    seeds = mix(np.array([0xC0DE, level * 32 + run + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    drawn = mix(np.array([seeds[0] ^ seeds[1]]))[0] | np.uint64(1)
    bound = np.minimum(paths.chosen(level) / size, 1.0) * 2.0**63
    return np.flatnonzero(((value ^ seeds[1]) * drawn >> np.uint64(1)).astype(np.float64) <= bound)


def _lists(doc: np.ndarray, values: np.ndarray, rows: int) -> pa.Array:
    order = np.argsort(doc, kind="stable")
    bounds = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=rows))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(values[order].view(np.int64)))


def _sketches(value: np.ndarray, doc: np.ndarray, rows: int, bins: int) -> np.ndarray:
    """For each set the least hash of each bin, in 16 bits; 0: an empty bin."""
    hashed = seeded(value, 5)
    bin_ = (hashed % np.uint64(bins)).astype(np.int64)
    least = np.full(rows * bins, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, doc * bins + bin_, hashed)
    out = (mix(least) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
    out[least == np.iinfo(np.uint64).max] = 0
    return out.reshape(rows, bins)


_ROW = "s1 bigint, s2 bigint, n bigint, first array<bigint>, further array<bigint>, sketch binary"


def _rows(docs: DataFrame, paths: Paths) -> DataFrame:
    """For each document the key of its set, its chosen shingles and its sketch. Codes carry run and level in their low byte."""
    runs = paths.runs()

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            rows = part.num_rows
            value, doc = distinct(*shingles(part.column("text"), paths.shingle))
            n = np.bincount(doc, minlength=rows)
            keys = []
            for seed in (1, 2):
                total = np.zeros(rows, np.uint64)
                np.add.at(total, doc, seeded(value, seed))
                keys.append(pa.array(mix(total).view(np.int64)))
            chosen: list[list[tuple[np.ndarray, np.ndarray]]] = [[], []]
            size = n[doc].astype(np.float64)
            for level in range(paths.levels):
                for run in range(runs):
                    at = _choices(value, size, paths, level, run)
                    code = (seeded(value[at], 9) & ~np.uint64(_CODE)) | np.uint64(level * 32 + run)
                    chosen[level > 0].append((doc[at], code))
            lists = [_lists(np.concatenate([x[0] for x in c]), np.concatenate([x[1] for x in c]), rows) for c in chosen]
            sketch = _sketches(value, doc, rows, paths.bins)
            yield pa.record_batch(
                [part.column("id"), *keys, pa.array(n), *lists, pa.array([x.tobytes() for x in sketch], pa.binary())],
                ["id", "s1", "s2", "n", "first", "further", "sketch"],
            )

    return docs.mapInArrow(describe, f"id bigint, {_ROW}")


def _candidates(sets: DataFrame, paths: Paths) -> DataFrame:
    """Edges (a, b) between sets that share a bucket and pass the comparison of sketches."""
    run = F.col("code").bitwiseAND(31)
    members = sets.select("node", F.explode("first").alias("code")).select(F.col("code").alias("bucket"), "node", run.alias("run"))
    edges = []
    for level in range(paths.levels):
        sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        # a frequent bucket's members are many rows of one key: the lookup lets them be split over tasks
        members = staged(lookup(members, sizes, {"bucket": "bucket"}, "node", how="inner"), "members")
        small = members.where(F.col("size") <= paths.bucket).select("bucket", "node").join(sets.select("node", "n", "sketch"), "node")
        edges.append(_compared(small, paths))
        large = members.where(F.col("size") > paths.bucket)
        if level == paths.levels - 1:
            least = large.groupBy("bucket").agg(F.min("node").alias("b"))
            edges.append(large.join(least, "bucket").select(F.col("node").alias("a"), "b"))
            break
        code = (level + 1) * 32
        wanted = F.expr(f"explode(filter(further, x -> (x & 255) = {code} + run))").alias("code")
        members = (
            large.join(sets.select("node", "further"), "node")
            .select("bucket", "node", "run", wanted)
            .select(F.xxhash64("bucket", "code").alias("bucket"), "node", "run")
        )
    out = edges[0]
    for more in edges[1:]:
        out = out.union(more)
    return out.where("a <> b")


def _compared(members: DataFrame, paths: Paths) -> DataFrame:
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_groups(batches, "bucket", 1 << 12):
            bucket, node, n = (part[c].to_numpy() for c in ("bucket", "node", "n"))
            data = part["sketch"].combine_chunks()
            sketch = np.frombuffer(b"".join(data.to_pylist()), np.uint16).reshape(len(node), paths.bins)
            new = np.append(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, len(bucket))
            after = new[np.searchsorted(new, np.arange(len(bucket)), "right")] - np.arange(len(bucket)) - 1
            label = np.arange(len(node))
            links = []
            for at in _runs_of(after, 1 << 15):
                a = np.repeat(np.arange(at.start, at.stop), after[at])
                b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(after[at]) - after[at], after[at])
                near = np.minimum(n[a], n[b]) >= paths.threshold * np.maximum(n[a], n[b]) - 1e-9
                a, b = a[near], b[near]
                x, y = sketch[a], sketch[b]
                filled = np.maximum(((x > 0) | (y > 0)).sum(1), 1)
                same = ((x == y) & (x > 0)).sum(1)
                # more than six standard deviations below the threshold
                good = same / filled >= paths.threshold - 3 / np.sqrt(filled)
                links.append((a[good], b[good]))
            a, b = (np.concatenate([x[i] for x in links]) for i in range(2))
            label = spread(label, a, b)
            # the label of a group is its first row
            yield pa.record_batch([pa.array(node), pa.array(node[label])], ["a", "b"])

    ordered = members.repartition("bucket").sortWithinPartitions("bucket")
    return ordered.mapInArrow(compare, "a bigint, b bigint").where("a <> b")


def _runs_of(weights: np.ndarray, most: int) -> Iterator[slice]:
    """Slices with a total weight of about `most`."""
    total, at = np.cumsum(weights), 0
    while at < len(weights):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + most, "right")))
        yield slice(at, to)
        at = to


def spread(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least label of everything that is connected by the links a - b; labels are places."""
    while len(a):
        before = label.copy()
        np.minimum.at(label, a, label[b])
        np.minimum.at(label, b, label[a])
        label = np.minimum(label, label[label])
        if (label == before).all():
            break
    return label


def _verified(texts: DataFrame, paths: Paths) -> DataFrame:
    """(node, links, root) of each block of (block, side, node, copies, text): copies that a set is linked to, and the
    least node that it is connected to inside the block. In a block of two sides only links across count."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "block", 1 << 20, "text"):
            block = table["block"].to_numpy()
            bounds = np.concatenate([[0], np.flatnonzero(block[1:] != block[:-1]) + 1, [len(block)]])
            value, doc = sets_of(table["text"].combine_chunks(), paths.shingle)
            node, side, copies = (table[c].to_numpy() for c in ("node", "side", "copies"))
            ends = np.searchsorted(doc, bounds)
            out: list[tuple] = []
            for i, (begin, end) in enumerate(zip(bounds, bounds[1:], strict=False)):
                inner = slice(ends[i], ends[i + 1])
                out.append(_links(value[inner], doc[inner] - begin, node[begin:end], side[begin:end], copies[begin:end], paths))
            columns = [np.concatenate(c) for c in zip(*out, strict=True)]
            yield pa.record_batch([pa.array(c.astype(np.int64)) for c in columns], ["node", "links", "root"])

    # the work of a block is not in proportion to its bytes: tasks must not be merged by size
    ordered = texts.repartition(salts_of(texts.sparkSession), "block").sortWithinPartitions("block")
    return ordered.mapInArrow(verify, "node bigint, links bigint, root bigint")


def _links(value, doc, node, side, copies, paths):  # noqa: ANN001, ANN202
    """Exact links inside one block; repeated rows of a node count once."""
    rows, one = np.unique(node, return_index=True)
    place = np.full(len(node), -1)
    place[one] = np.arange(len(one))
    doc = place[doc]
    value, doc = value[doc >= 0], doc[doc >= 0]
    side, copies, m = side[one], copies[one], len(one)
    n = np.bincount(doc, minlength=m)
    _, column, often = np.unique(value, return_inverse=True, return_counts=True)
    shared = often[column] > 1
    _, column = np.unique(column[shared], return_inverse=True)
    doc = doc[shared]
    order = np.argsort(column, kind="stable")
    column, doc = column[order], doc[order]
    common = np.zeros((m, m), np.float32)
    width = max(1, (1 << 20) // max(m, 1))
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        at = slice(*np.searchsorted(column, [start, start + width]))
        held_by = np.zeros((m, width), np.float32)
        held_by[doc[at], column[at] - start] = 1
        common += held_by @ held_by.T
    union = n[:, None] + n[None, :] - common
    linked = common >= paths.threshold * union - 1e-6
    linked &= (n[:, None] > 0) & (n[None, :] > 0)
    np.fill_diagonal(linked, False)
    if side.max() > 0:  # not a block of one part with itself, whether both parts have members or not
        linked &= side[:, None] != side[None, :]
    a, b = np.nonzero(linked)
    root = spread(np.arange(m), a, b)
    return rows, linked @ copies, rows[root]


def joined(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", paths: Paths | None = None) -> DataFrame:
    """One row per document: its group `class_id`, the document `copy_of` that stands for its set, and `n_links`."""
    small_batches(docs.sparkSession)
    paths = paths or Paths()
    docs = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    rows = staged(_rows(docs, paths), "rows")
    sets = (
        rows.where("n > 0")
        .groupBy("s1", "s2")
        .agg(
            F.min("id").alias("least"),
            F.count(F.lit(1)).alias("copies"),
            *(F.first(c).alias(c) for c in ("n", "first", "further", "sketch")),
        )
        # sets have numbers of their own, fixed by the staged table: an id may be any integer, or lack
        .withColumn("node", F.monotonically_increasing_id())
    )
    sets = staged(sets, "sets")
    edges = _candidates(sets, paths)
    groups = staged(components(edges), "groups")
    found = _exact(docs, sets, groups, paths)
    answer = sets.select("s1", "s2", "copies", "least", "node").join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    answer = staged(answer, "answer")
    least = answer.groupBy("root").agg(F.min("least").alias("class_id"))
    answer = lookup(answer, least, {"root": "root"}, "node").select(
        "s1", "s2", "class_id", F.col("least").alias("copy_of"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    alone = F.col("n") == 0  # sets without shingles stay apart: they ask for no answer
    keyed = [F.when(F.col("n") > 0, F.col(c)).alias(c) for c in ("s1", "s2")]
    return lookup(rows.select("id", "n", *keyed), answer, {"s1": "s1", "s2": "s2"}, "id").select(
        F.col("id").alias(id_column),
        F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("id")).otherwise(F.col("copy_of")).alias("copy_of"),
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
    )


def _exact(docs: DataFrame, sets: DataFrame, groups: DataFrame, paths: Paths) -> DataFrame:
    """(node, links, root) by exact verification inside the candidate groups."""
    spark = docs.sparkSession
    members = groups.join(sets.select("node", "n", "s1", "s2", "copies"), "node")
    sizes = members.groupBy("root").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("total"))
    members = members.join(sizes, "root")
    blocks = F.greatest(F.ceil(F.col("size") / paths.block), F.ceil(F.col("total") / paths.block_shingles))
    members = members.select(
        "node", "root", "copies", "s1", "s2", blocks.alias("blocks"), F.pmod(F.xxhash64("node"), blocks).alias("own"),
    )
    wanted = spark.sparkContext.broadcast(bitmap(members.select(F.col("s1").alias("key")), "key", BITS))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents that may be members, with the key of their set."""
        for part in slices(batches, "text"):
            rows = part.num_rows
            value, doc = distinct(*shingles(part.column("text"), paths.shingle))
            keys = []
            for seed in (1, 2):
                total = np.zeros(rows, np.uint64)
                np.add.at(total, doc, seeded(value, seed))
                keys.append(mix(total).view(np.int64))
            at = np.flatnonzero(held(wanted.value, keys[0].view(np.uint64), BITS))
            _, first = np.unique(keys[0][at], return_index=True)
            at = pa.array(at[first])
            yield pa.record_batch([pa.array(k).take(at) for k in keys] + [part.column("text").take(at)], ["s1", "s2", "text"])

    texts = docs.select("text").mapInArrow(keyed, "s1 bigint, s2 bigint, text string")
    # one text of each set is enough; the least is as good as any. Each task hands on one of a set, however many copies it has
    texts = texts.groupBy("s1", "s2").agg(F.min("text").alias("text")).join(members, ["s1", "s2"])
    pairs = F.expr("explode(transform(sequence(0L, blocks - 1), other -> struct(least(own, other) as low, greatest(own, other) as high)))")
    spread_out = texts.select("node", "root", "copies", "own", "text", "blocks", pairs.alias("pair")).select(
        F.xxhash64("root", "pair.low", "pair.high").alias("block"),
        F.when(F.col("pair.low") == F.col("pair.high"), 0).when(F.col("own") == F.col("pair.low"), 1).otherwise(2).alias("side"),
        "node", "copies", "text",
    )
    counted = staged(_verified(spread_out, paths), "verified")
    links = counted.groupBy("node").agg(F.sum("links").alias("links"))
    linked = components(counted.select(F.col("node").alias("a"), F.col("root").alias("b")).where("a <> b"))
    return links.join(linked, "node", "left")
