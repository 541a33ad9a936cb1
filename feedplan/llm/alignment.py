"""Alignment of two tokenizations of the same bytes.

Both tokenizers cut the same byte string; where two tokens end together, a group
ends. Most groups are one token to one token, so the two arrays of ends agree
over long stretches once one of them is shifted: from a common end on, the two
arrays are compared at the current shift over windows that double in size, and
a stretch is jumped as a whole. Where they differ, the group is resolved token by
token, and its sizes give the next shift.

A text is cut where a blank follows a word. No token of either tokenizer holds a
blank behind something else, so both tokenize and align the parts as they do
inside the text, and every different part is worked out once for as long as a
worker remembers it.

Counts of linked ids need all documents. Tasks write slices of the corpus: for
the documents their parts, and for the slice its different links with the number
of documents that hold them. Links are counted by a shuffle, and the counts come
back to each slice by another; a slice has a bounded number of bytes, and no
link is sent once for each document.

Defined results: texts that are null or empty, or that one tokenizer does not
give back (the second one writes U+2581 for a blank) have no tokens: zeros, and
an empty digest. Rows that are repeated, or that share an id, are documents of
their own. A null id is kept. An empty table gives no rows. Other columns are not
looked at.
"""

from __future__ import annotations

import ctypes
import gc
import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from feedplan.llm.span_memory import Ragged, SpanMemory, places
from feedplan.llm.token_counts import WHITE, _byte_letters
from feedplan.llm.words import bytes_of, slices, small_batches
from feedplan.operators.lookup import lookup
from feedplan.sources.staging import staged

#: Parts that a Python worker remembers, and parts that are encoded at once: bound its memory, not the result.
REMEMBERED, TOGETHER = 400_000, 1 << 13
#: Bytes of text in a slice.
SLICE = 1 << 20
#: Slices that one task answers: a slice takes a few MB, in whole rows that are sorted and handed to Python.
ANSWERED = 16
#: Ends of a stretch that are compared first.
PROBE = 4
#: A link is a number: the first id above these bits, the second one in them.
BITS = 16


def align(ends_a: list[int], ends_b: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links (token of A, token of B) in order, and the group of each. Both arrays ascend and have the same last end."""
    a, b, group = [], [], []
    i = j = groups = 0
    n = len(ends_a)
    while i < n:
        if ends_a[i] == ends_b[j]:
            # one to one: probe windows that double, then halve the one that differs
            run, step = 1, PROBE
            while (window := ends_a[i + run : i + run + step]) and window == ends_b[j + run : j + run + step]:
                run, step = run + len(window), step * 2
            while step := step // 2:
                if (window := ends_a[i + run : i + run + step]) and window == ends_b[j + run : j + run + step]:
                    run += len(window)
            a.extend(range(i, i + run))
            b.extend(range(j, j + run))
            group.extend(range(groups, groups + run))
            i, j, groups = i + run, j + run, groups + run
            continue
        while True:  # an irregular group: whichever token ends first makes way for the next one
            a.append(i)
            b.append(j)
            group.append(groups)
            x, y = ends_a[i], ends_b[j]
            i, j = i + (x <= y), j + (y <= x)
            if x == y:
                break
        groups += 1
    return np.array(a, np.int64), np.array(b, np.int64), np.array(group, np.int64)


def _parts(data: np.ndarray, bounds: np.ndarray, blanks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each part: texts (none of them empty) are cut before those blanks that follow no white space."""
    white = np.zeros(len(data), bool)  # at the last byte of each white space character
    for point in WHITE:
        code = chr(point).encode()
        if len(code) == 1:
            white |= data == code[0]
    lead = np.flatnonzero(np.isin(data, [0xC2, 0xE1, 0xE2, 0xE3]))
    if len(lead):
        for point in WHITE:
            code = chr(point).encode()
            if len(code) > 1:
                at = lead[(lead + len(code) <= len(data)) & (data[lead] == code[0])]
                for k, byte in enumerate(code):
                    at = at[data[at + k] == byte]
                white[at + len(code) - 1] = True
    cut = blanks[data]
    cut[1:] &= ~white[:-1]
    cut[bounds[:-1]] = True
    start = np.flatnonzero(cut)
    return start, np.append(start[1:], len(data))


class Aligner:
    """Two tokenizers, and the aligned parts that were met before."""

    def __init__(self, path_a: str, path_b: str):
        self._a = Tokenizer.from_file(path_a)
        self._a.encode_special_tokens = True
        self._b = SentencePieceProcessor(model_file=path_b)
        letters = _byte_letters()
        with open(path_a, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        bytes_a = {i: bytes(letters[c] for c in token) if all(c in letters for c in token) else b"" for token, i in vocabulary.items()}
        bytes_b = {i: self._bytes_b(i) for i in range(self._b.get_piece_size())}
        if max(*bytes_a, *bytes_b) >> BITS:
            raise ValueError("ids do not fit the bits of a link")
        self._bytes = [[x.get(i, b"") for i in range(max(x) + 1)] for x in (bytes_a, bytes_b)]
        self._sizes = [np.array([len(t) for t in x], np.int64) for x in self._bytes]
        # texts are cut before these: white space that no token of B has behind something else
        white = "".join(map(chr, WHITE))
        spelled = [token.decode("utf-8", "replace") for token in bytes_b.values()]
        inner = {c for token in spelled for before, c in zip(token, token[1:], strict=False) if c in white and before not in white}
        self.blanks = np.zeros(256, bool)
        self.blanks[[ord(c) for c in white if c.isascii() and c not in inner]] = True
        if not self.blanks[0x20]:
            raise ValueError("tokens go across blanks")
        # ids in decimal digits, with what may follow them
        self._texts = Ragged(np.uint8)
        texts = [f"{i}{after}".encode() for after in ",|;" for i in range(1 << BITS)]
        self._texts.append(np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts]))
        # links; groups as text; tokens of A and of B, groups, and whether the bytes differ
        self.memory = SpanMemory(self._learn, [np.uint32, np.uint8, np.int32], REMEMBERED)

    def _bytes_b(self, i: int) -> bytes:
        if self._b.is_control(i) or self._b.is_unknown(i):
            return b""
        piece = self._b.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if self._b.is_byte(i) else piece.replace("▁", " ").encode()

    def _learn(self, parts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        texts = [p.decode() for p in parts]
        # parts that end in white space, and those that one tokenizer does not give back, stand alone
        alone = [t[-1].isspace() or "▁" in t for t in texts]
        together = [i for i, x in enumerate(alone) if not x]
        bundles = [together[at : at + TOGETHER] for at in range(0, len(together), TOGETHER)] + [[i] for i, x in enumerate(alone) if x]
        found, order = [], []
        while bundles:
            bundle = bundles.pop()
            answer = self._aligned([parts[i] for i in bundle])
            if answer is None and len(bundle) > 1:
                bundles.extend([i] for i in bundle)
                continue
            nothing = np.zeros(0, np.uint32)
            found.append(answer or [(nothing, [0]), (nothing.astype(np.uint8), [0]), (np.array([0, 0, 0, 1], np.int32), [4])])
            order.extend(bundle)
        back = np.argsort(order)
        out = []
        for column in range(3):
            flat, sizes = np.concatenate([f[column][0] for f in found]), np.concatenate([f[column][1] for f in found]).astype(np.int64)
            begin = np.cumsum(sizes) - sizes
            out.append((flat[places(begin[back], sizes[back])], sizes[back]))
        return out

    def _aligned(self, parts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """The columns of parts that are encoded in a row, behind a word; None if the bytes differ."""
        whole = b" a" + b"".join(parts)
        text = whole.decode()
        ids = [self._a.encode_batch_fast([text], add_special_tokens=False)[0].ids, self._b.encode(text[1:], num_threads=1)]
        if any(b"".join(map(names.__getitem__, x)) != whole for names, x in zip(self._bytes, ids, strict=True)):
            return None
        ids = [np.array(x, np.int64) for x in ids]
        ends = [np.cumsum(sizes[x]) for sizes, x in zip(self._sizes, ids, strict=True)]
        bounds = np.cumsum([2, *map(len, parts)])
        cuts = [np.searchsorted(e, bounds) + 1 for e in ends]  # tokens up to the end of each part
        if any((e[c - 1] != bounds).any() for e, c in zip(ends, cuts, strict=True)):
            return None
        link_a, link_b, group = align(ends[0].tolist(), ends[1].tolist())
        codes = (ids[0][link_a] << BITS | ids[1][link_b]).astype(np.uint32)
        # the group of each token, and from there where the groups and the links of each part end
        groups = [group[np.searchsorted(link, np.arange(len(x)))] for link, x in zip((link_a, link_b), ids, strict=True)]
        group_cut = groups[0][cuts[0] - 1] + 1
        link_cut = np.searchsorted(group, group_cut)
        last = [np.append(g[1:] != g[:-1], True) for g in groups]
        side = np.concatenate([2 * groups[0], 2 * groups[1] + 1])
        after = np.concatenate([last[0] * 1, last[1] * 2])  # a comma, or what ends the tokens of A or of B
        ordered = np.argsort(side, kind="stable")
        letters, sizes = self._texts.take((after << BITS | np.concatenate(ids))[ordered])
        ends_of = np.append(0, np.cumsum(sizes))[np.searchsorted(side[ordered], 2 * group_cut)]
        counts = np.stack([np.diff(cuts[0]), np.diff(cuts[1]), np.diff(group_cut), np.zeros(len(parts), np.int64)], 1)
        return [
            (codes[link_cut[0] :], np.diff(link_cut)),
            (letters[ends_of[0] :], np.diff(ends_of)),
            (counts.astype(np.int32).ravel(), np.full(len(parts), 4)),
        ]

    def __call__(self, texts: pa.Array) -> dict[str, np.ndarray | list]:
        """For texts: counts and digests of each, its parts, and the links of each part that is met among them."""
        n = len(texts)
        texts = texts.cast(pa.large_string())
        asked = np.flatnonzero(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
        data, bounds = bytes_of(pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts.take(pa.array(asked)), pa.scalar("", pa.large_string())))
        start, end = _parts(data, bounds, self.blanks) if len(asked) else (np.zeros(0, np.int64),) * 2
        doc = asked[np.searchsorted(bounds, start, "right") - 1] if len(asked) else start
        entry = self.memory.find(data, start, end)
        counts = self.memory.columns[2].take(entry)[0].reshape(-1, 4)
        good = np.bincount(doc, weights=counts[:, 3], minlength=n) == 0
        kept = good[doc]
        doc, entry, counts = doc[kept], entry[kept], counts[kept]
        digests = self._digests(doc, entry, n)
        distinct, parts = np.unique(entry, return_inverse=True)
        links, link_sizes = self.memory.columns[0].take(distinct)
        numbers = [np.bincount(doc, weights=counts[:, i], minlength=n).astype(np.int64) for i in range(3)]
        n_links = np.bincount(doc, weights=link_sizes[parts], minlength=n).astype(np.int64)
        # in how many of the texts each link is
        own = np.unique(doc << 32 | parts)
        size = link_sizes[own & 0xFFFFFFFF]
        begin = (np.cumsum(link_sizes) - link_sizes)[own & 0xFFFFFFFF]
        held = np.unique(np.repeat(own >> 32, size) << 32 | links[places(begin, size)])
        codes, docs = np.unique(held & 0xFFFFFFFF, return_counts=True)
        return {
            "n_a": numbers[0], "n_b": numbers[1], "n_groups": numbers[2], "n_links": n_links, "groups_sha256": digests,
            "n_parts": np.bincount(doc, minlength=n), "parts": parts.astype(np.int32), "links": links, "link_sizes": link_sizes.astype(np.int32),
            "codes": codes, "docs": docs,
        }


    def _digests(self, doc: np.ndarray, entry: np.ndarray, n: int, most: int = 1 << 16) -> list[str]:
        """Digests of the groups of each text, put together for some parts at a time: bounds the memory."""
        column, out = self.memory.columns[1], [""] * n
        begin, end = (np.searchsorted(doc, np.arange(n), side) for side in ("left", "right"))
        for text in np.flatnonzero(end > begin).tolist():
            digest, at, stop = hashlib.sha256(), int(begin[text]), int(end[text])
            while at < stop:
                to = min(at + most, stop)
                letters, _ = column.take(entry[at:to])
                digest.update(memoryview(letters)[: -1 if to == stop else None])  # the last group ends without a semicolon
                at = to
            out[text] = digest.hexdigest()
        return out


@lru_cache(2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def _give_back() -> None:
    """Hand freed memory back to the system: a worker waits on while the stages after it need the executor's memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


_OWN = ("n_a", "n_b", "n_groups", "n_links")


def _sliced(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row for each slice of the documents (id, text)."""
    id_type = docs.schema["id"].dataType

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, align_all = TaskContext.get().partitionId() << 32, aligner(path_a, path_b)
        for part in _gathered(batches):
            found = align_all(part.column("text"))
            lists = [part.column("id"), *(pa.array(found[c]) for c in (*_OWN, "groups_sha256", "n_parts", "codes", "docs"))]
            whole = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists]
            binary = [pa.array([found[c].tobytes()], pa.binary()) for c in ("parts", "links", "link_sizes")]
            yield pa.record_batch([pa.array([number], pa.int64()), *whole, *binary], ["slice", "id", *_OWN, "groups_sha256", "n_parts", "codes", "docs", "parts", "links", "link_sizes"])
            number += 1
        _give_back()

    longs = T.ArrayType(T.LongType())
    fields = [("slice", T.LongType()), ("id", T.ArrayType(id_type)), *((c, longs) for c in _OWN), ("groups_sha256", T.ArrayType(T.StringType())), ("n_parts", longs), ("codes", longs), ("docs", longs)]
    schema = T.StructType([T.StructField(c, t) for c, t in fields] + [T.StructField(c, T.BinaryType()) for c in ("parts", "links", "link_sizes")])
    return docs.select("id", "text").mapInArrow(work, schema)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of about one slice."""
    held: list[pa.RecordBatch] = []
    filled = 0
    for part in slices(batches, "text", SLICE):
        held.append(part)
        filled += part.column("text").nbytes
        if filled >= SLICE:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, filled = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _answered(rows: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of one slice, with the sums over their links."""
    if aligner.cache_info().currsize:  # left by the slices in a worker that is used again
        aligner.cache_clear()
        gc.collect()
        _give_back()
    row = {c: rows[c][0] for c in rows.column_names}
    code, count, best = (counts[c].to_numpy() for c in ("code", "count", "best"))
    order = np.argsort(code)
    links, sizes, parts = (np.frombuffer(row[c].as_py(), t) for c, t in (("links", np.uint32), ("link_sizes", np.int32), ("parts", np.int32)))
    at = order[np.searchsorted(code, links, sorter=order)] if len(links) else np.zeros(0, np.int64)
    n_parts = row["n_parts"].values.to_numpy()
    doc = np.repeat(np.arange(len(n_parts)), n_parts)
    part_of = np.repeat(np.arange(len(sizes)), sizes)
    sums = []
    for values in (best, count):  # sums over the links of a part, then over the parts of a document; all in integers
        own = np.zeros(len(sizes), np.int64)
        np.add.at(own, part_of, values[at].astype(np.int64))
        total = np.zeros(len(n_parts), np.int64)
        np.add.at(total, doc, own[parts])
        sums.append(pa.array(total))
    columns = [row["id"].values, *(row[c].values for c in _OWN), *sums, row["groups_sha256"].values]
    return pa.table(columns, ["id", *_OWN, "n_best", "count_sum", "groups_sha256"])


def aligned(docs: DataFrame, path_a: str, path_b: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: tokens, groups and links, and how its links stand in the whole corpus."""
    small_batches(docs.sparkSession)
    named = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    sliced = staged(_sliced(named, path_a, path_b), "slices")
    links = sliced.select("slice", F.explode(F.arrays_zip("codes", "docs")).alias("link")).select("slice", F.col("link.codes").alias("code"), F.col("link.docs").alias("docs"))
    counts = links.groupBy("code").agg(F.sum("docs").alias("count")).withColumn("a", F.shiftright("code", BITS))
    counts = staged(counts, "links")
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    counts = lookup(counts, most, {"a": "a"}, "code").select("code", "count", (F.col("count") == F.col("most")).cast("int").alias("best"))
    # a link that is everywhere has a row for each slice: the lookup lets these be split over tasks
    answers = lookup(links.select(F.col("slice").alias("of"), "code"), counts, {"code": "code"}, "of", how="inner")
    schema = T.StructType([
        T.StructField("id", named.schema["id"].dataType), *(T.StructField(c, T.LongType()) for c in (*_OWN, "n_best", "count_sum")), T.StructField("groups_sha256", T.StringType()),
    ])
    # whole slices are sorted in the tasks that answer them, so their number goes with the slices, not with the session
    tasks = max(1, -(-sliced.count() // ANSWERED))
    own, answers = sliced.drop("codes", "docs").repartition(tasks, "slice"), answers.repartition(tasks, "of")
    found = own.groupBy("slice").cogroup(answers.groupBy("of")).applyInArrow(_answered, schema)
    return found.withColumnRenamed("id", id_column)
