"""Delimited feed: reading, header contract and record numbers.

Quoted cells may hold separators, quotes and line breaks, so where a record
begins depends on everything before it. The dependence is a small one: whether a
split of a file begins inside a quoted cell. An automaton of five states reads
the bytes of all splits in parallel, from every state at once; what a split does
to a state, and how many records begin in it, are a few numbers. Composed in the
order of the splits they tell each split its state and the number of its first
record. The second pass parses every split on its own; only a record that goes
on in the next split is put together by a shuffle of its pieces.
"""

from __future__ import annotations

import csv
import hashlib
import io
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedplan.functions.text import clean_null_token
from feedplan.sources.staging import staged


class CsvFormatError(ValueError):
    """The feed does not have the columns it must have."""


def check_header(found: Sequence[str], required: Sequence[str]) -> None:
    """All required names must occur, in any order; others are allowed."""
    if not found:
        raise CsvFormatError("Missing header in source CSV")
    missing = [n for n in required if n not in found]
    if missing:
        raise CsvFormatError(f"Missing required columns in source CSV: {', '.join(missing)}")


# States: before a record, before a cell, in a plain cell, in a quoted one, and behind a quote in a quoted one. At the
# beginning of a line only the first and QUOTED are possible.
RECORD, CELL, PLAIN, QUOTED, QUOTE = range(5)
# Kinds of bytes; the last one fills up chunks and changes nothing.
_LETTER, _MARK, _COMMA, _BREAK, _FILL = range(5)
#: Next state by state and kind. A quote counts at the beginning of a cell only; behind a closed quotation the cell goes
#: on as a plain one.
_TO = np.array([
    [PLAIN, QUOTED, CELL, RECORD, RECORD],
    [PLAIN, QUOTED, CELL, RECORD, CELL],
    [PLAIN, PLAIN, CELL, RECORD, PLAIN],
    [QUOTED, QUOTE, QUOTED, QUOTED, QUOTED],
    [PLAIN, QUOTED, CELL, RECORD, QUOTE],
], np.uint8).ravel()
#: A record begins with the first byte that is no line break.
_BEGINS = np.array([[1, 1, 1, 0, 0], *[[0] * 5] * 4], np.int64).ravel()
_KIND = np.full(256, _LETTER, np.uint8)
_KIND[list(b'"')], _KIND[list(b",")], _KIND[list(b"\r\n")] = _MARK, _COMMA, _BREAK
_CHUNK = 256
#: Cells may be as long as a Python string.
csv.field_size_limit((1 << 31) - 1)


@dataclass
class Effect:
    """What bytes do to each state: the state behind them, and the records that begin in them."""

    exits: np.ndarray
    begins: np.ndarray

    @classmethod
    def none(cls) -> Effect:
        return cls(np.arange(5), np.zeros(5, np.int64))

    @classmethod
    def of(cls, data: bytes) -> Effect:
        """All chunks of the bytes are run side by side from all states; then their effects are composed."""
        kinds = _KIND[np.frombuffer(data, np.uint8)]
        letter = kinds == _LETTER
        letter[1:] &= letter[:-1].copy()
        letter[:1] = False
        kinds = kinds[~letter]  # a run of letters is like one
        rows = -(-len(kinds) // _CHUNK)
        filled = np.full(rows * _CHUNK, _FILL, np.uint8)
        filled[: len(kinds)] = kinds
        state = np.repeat(np.arange(5, dtype=np.uint8)[None, :], rows, 0)
        begins = np.zeros((rows, 5), np.int64)
        for column in np.ascontiguousarray(filled.reshape(rows, _CHUNK).T):
            key = state * np.uint8(5) + column[:, None]
            begins += _BEGINS.take(key)
            state = _TO.take(key)
        while len(state) > 1:  # neighbours together, until one is left
            if len(state) % 2:
                state, begins = np.append(state, [np.arange(5, dtype=np.uint8)], 0), np.append(begins, np.zeros((1, 5), np.int64), 0)
            first, then = state[::2].astype(np.int64), state[1::2]
            begins = begins[::2] + np.take_along_axis(begins[1::2], first, 1)
            state = np.take_along_axis(then, first, 1)
        return cls(state[0].astype(np.int64), begins[0]) if rows else cls.none()

    def then(self, other: Effect) -> Effect:
        return Effect(other.exits[self.exits], self.begins + other.begins[self.exits])


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines up to each line feed, in order inside a split."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )


def _splits(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator[list[str]]]]:
    """(file, block) of each split, and its lines in lists."""

    def runs() -> Iterator[tuple[tuple[str, int], list[str]]]:
        for batch in batches:
            if not batch.num_rows:
                continue
            file, block = batch.column("file").dictionary_encode(), batch.column("block").to_numpy()
            index = file.indices.to_numpy()
            begins = np.flatnonzero((index[1:] != index[:-1]) | (block[1:] != block[:-1])) + 1
            for begin, end in zip([0, *begins.tolist()], [*begins.tolist(), batch.num_rows], strict=True):
                key = (file.dictionary[int(index[begin])].as_py(), int(block[begin]))
                yield key, batch.column("value").slice(begin, end - begin).to_pylist()

    for key, group in groupby(runs(), key=lambda r: r[0]):
        yield key, _without_mark((lines for _, lines in group), key[1] == 0)


def _without_mark(groups: Iterator[list[str]], first: bool) -> Iterator[list[str]]:
    """The lines without the byte order mark of a file."""
    for lines in groups:
        if first:
            lines[0] = lines[0].removeprefix("\ufeff")
        first = False
        yield lines


def _broken(groups: Iterable[list[str]]) -> Iterator[str]:
    """Lines with their line breaks, also those that end with a carriage return."""
    for lines in groups:
        for line in lines:
            if "\r" in line:
                yield from io.StringIO(line + "\n", newline="")
            else:
                yield line + "\n"


def _key(file: str, block: int) -> int:
    return int.from_bytes(hashlib.blake2b(f"{block}:{file}".encode(), digest_size=8).digest(), "little", signed=True)


_EFFECT = "file string, block bigint, key bigint, exit_record int, exit_quoted int, begins_record bigint, begins_quoted bigint, header array<string>"


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each split; the first split of a file has its first record as well."""
    for (file, block), groups in _splits(batches):
        effect, beginning, header = Effect.none(), [], None
        for lines in groups:
            text = "\n".join(lines) + "\n"
            effect = effect.then(Effect.of(text.encode()))
            if block == 0 and header is None:
                beginning.append(lines)
                records = (r for r in csv.reader(_broken(beginning)) if r)
                found, more = next(records, None), next(records, None)
                header = found if more is not None else None  # a record that another one follows is whole
        if block == 0 and header is None:
            header = next((r for r in csv.reader(_broken(beginning)) if r), None)
        numbers = [block, _key(file, block), *(int(effect.exits[s]) for s in (RECORD, QUOTED)), *(int(effect.begins[s]) for s in (RECORD, QUOTED))]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        columns = [pa.array([file]), *(pa.array([n], k) for n, k in zip(numbers, kinds, strict=True)), pa.array([header], pa.list_(pa.string()))]
        yield pa.record_batch(columns, [c.split()[0] for c in _EFFECT.split(", ")])


@dataclass(frozen=True)
class Starts:
    """For each split, by the hash of its place: whether it begins inside a quoted cell, the number of the first record
    that begins in it, and how many do. Some 26 bytes for a split of 128 MB: 20 MB for 100 TB."""

    key: np.ndarray
    quoted: np.ndarray
    number: np.ndarray
    begins: np.ndarray
    torn: bool  # whether a record goes on behind any split, or a quotation never ends

    @classmethod
    def of(cls, splits: DataFrame, first: int, has_header: bool) -> Starts:
        rows = splits.orderBy("file", "block").select("key", "block", "exit_record", "exit_quoted", "begins_record", "begins_quoted").toArrow()
        key, block, *rest = (rows[c].to_numpy() for c in rows.column_names)
        exits, begins = np.stack(rest[:2], 1) == QUOTED, np.stack(rest[2:], 1)
        quoted, is_open, torn = np.zeros(len(key), bool), False, False
        for i, new_file in enumerate((block == 0).tolist()):
            quoted[i] = is_open = is_open and not new_file
            is_open = bool(exits[i, int(is_open)])
            torn |= is_open
        own = begins[np.arange(len(key)), quoted.astype(int)]
        number = np.cumsum(own) - own + first
        if has_header:  # the first record of each file has no number
            number -= np.cumsum(block == 0)
        order = np.argsort(key)
        return cls(key[order], quoted[order], number[order], own[order], torn)

    def __call__(self, file: str, block: int) -> tuple[bool, int, int]:
        at = int(np.searchsorted(self.key, _key(file, block)))
        if at == len(self.key) or self.key[at] != _key(file, block):
            raise ValueError("file splits changed between two passes")
        return bool(self.quoted[at]), int(self.number[at]), int(self.begins[at])


def _parsed(groups: Iterable[list[str]], quoted: bool) -> Iterator[tuple[list[str] | None, str | None]]:
    """The records of a split as (cells, None); as (None, text) what belongs to the record that is open at its
    beginning, and the beginning of one that is open at its end. Blank records are left out."""
    lines = _broken(groups)
    if quoted:
        state, piece = QUOTED, []
        for line in lines:
            piece.append(line)
            state = int(Effect.of(line.encode()).exits[state])
            if state == RECORD:
                break
        yield None, "".join(piece)
    held: list[list[str]] = [[]]

    def feed() -> Iterator[str]:
        for line in lines:
            held[0].append(line)
            yield line

    last: tuple[list[str], list[str]] | None = None
    for cells in csv.reader(feed()):
        text, held[0] = held[0], []
        if not cells:
            continue
        if last is not None:
            yield last[0], None
        last = cells, text
    if last is not None:
        text = "".join(last[1])
        is_open = Effect.of(text.encode()).exits[RECORD] == QUOTED
        yield (None, text) if is_open else (last[0], None)


def _places(header: Sequence[str], columns: Sequence[str]) -> list[int]:
    """Where each column stands; of equal names the last one counts."""
    place = {name: i for i, name in enumerate(header)}
    return [place[c] for c in columns]


def read_cells(spark: SparkSession, path: str, columns: Sequence[str], has_header: bool = True) -> DataFrame:
    """Cells by name with ``line_no``: dense numbers over all files in the order of their names, from 2 below a header
    and from 1 without one.

    Short records give NULL, extra cells are ignored, blank lines are no records. Every file has the header of the
    first. A cell whose quotation never ends goes on to the end of the file. File scans give the same splits in both
    passes as long as ``spark.sql.files.minPartitionNum`` is fixed, which ``configure`` sees to; other splits fail.
    """
    splits = staged(_lines(spark, path).mapInArrow(_effects, _EFFECT), "splits")
    header = list(columns)
    if has_header:
        header = splits.where("header is not null").agg(F.min_by("header", "file")).first()[0] or []
        check_header(header, columns)
    starts = Starts.of(splits, 2 if has_header else 1, has_header)
    shared, places = spark.sparkContext.broadcast(starts), _places(header, columns)
    names = ["line_no", "at", "piece", *(f"c{i}" for i in range(len(columns)))]
    schema = ", ".join(["line_no bigint", "at bigint", *(f"`{n}` string" for n in names[2:])])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), *[pa.string()] * (len(names) - 2)]
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = (None,) * len(places)
        for (file, block), groups in _splits(batches):
            quoted, number, begins = shared.value(file, block)
            rows, end, is_header = [], number + begins, has_header and block == 0
            is_first = quoted
            for cells, piece in _parsed(groups, quoted):
                if is_first:  # goes on from the split before
                    rows.append((number - 1, block, piece, *nothing))
                elif is_header:
                    if cells is not None and cells != header:
                        raise CsvFormatError(f"header differs in {file}")
                    number += 1
                    is_header = False
                elif cells is None:
                    rows.append((number, block, piece, *nothing))
                    number += 1
                else:
                    n = len(cells)
                    rows.append((number, None, None, *[cells[i] if i < n else None for i in places]))
                    number += 1
                is_first = False
                if len(rows) >= 4096:
                    yield batch(rows)
                    rows = []
            if number != end:
                raise ValueError("file splits changed between two passes")
            if rows:
                yield batch(rows)

    found = _lines(spark, path).mapInArrow(parse, schema)
    own = [F.col(f"c{i}").alias(c) for i, c in enumerate(columns)]
    if not starts.torn:
        return found.select("line_no", *own)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            rows = []
            for number, pieces in zip(part.column("line_no").to_pylist(), part.column("pieces").to_pylist(), strict=True):
                cells = next(csv.reader(_broken([["".join(p["piece"] for p in pieces).removesuffix("\n")]])))
                rows.append((number, None, None, *[cells[i] if i < len(cells) else None for i in places]))
            if rows:
                yield batch(rows)

    found = staged(found, "records")
    whole = found.where("piece is null")
    pieces = found.where("piece is not null").groupBy("line_no").agg(F.sort_array(F.collect_list(F.struct("at", "piece"))).alias("pieces"))
    return whole.unionByName(pieces.mapInArrow(join, schema)).select("line_no", *own)


def read_feed(spark: SparkSession, path: str, columns: Sequence[str], has_header: bool = True) -> DataFrame:
    """Numbered records with cleaned cells (blank and ``null`` are NULL)."""
    cells = read_cells(spark, path, columns, has_header)
    return cells.selectExpr("line_no", "concat('line:', line_no) as record_id", *[f"{clean_null_token(f'`{c}`')} as `{c}`" for c in columns])
