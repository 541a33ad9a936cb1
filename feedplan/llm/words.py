"""Words of many texts at once, as numpy arrays.

A word is a maximal run of bytes other than blank, tab, line feed, vertical
tab, form feed and carriage return. Arrow hands over the texts of a batch as
one byte buffer; everything here works on that buffer, so there is no Python
loop over documents or words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

#: Bytes that part words: fixed values.
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeded(x: np.ndarray, seed: int) -> np.ndarray:
    """One of many independent hash functions of 64-bit values."""
    return mix(x ^ mix(np.array([seed + 1], np.uint64) * _GOLDEN)[0])


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _GOLDEN)
_BASE = np.uint64(0xD6E8FEB86659FD93)


def _powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Texts are long: let Arrow hand over fewer of them at once than the default, which is made for short rows."""
    if int(spark.conf.get(_ROWS)) > rows:
        spark.conf.set(_ROWS, str(rows))


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, and where each text starts (one more entry for the end). Null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    bounds = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


@dataclass
class Words:
    """Words of a batch of texts: their text, first byte and end (in `data`)."""

    data: np.ndarray
    bounds: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array) -> Words:
        data, bounds = bytes_of(texts)
        inside = ~_BLANK[data]
        first, last = inside.copy(), inside.copy()
        if len(data):
            first[1:] &= ~inside[:-1]
            last[:-1] &= ~inside[1:]
            edges = bounds[1:-1]
            edges = edges[(edges > 0) & (edges < len(data))]
            first[edges] = inside[edges]
            last[edges - 1] = inside[edges - 1]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        return cls(data, bounds, np.searchsorted(bounds, start, "right") - 1, start, end)

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        """Words of each text."""
        return np.bincount(self.doc, minlength=len(self.bounds) - 1)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        return span_hashes(self.data, self.start, self.end)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, part: int = 1 << 20) -> np.ndarray:
    """A 64-bit hash of each byte span; spans are not empty. Worked off in parts of about `part` bytes, whatever
    the size of the text."""
    size = end - start
    total = np.cumsum(size)
    out = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + part, "right")))
        out[at:to] = _hashes(data, start[at:to], size[at:to])
        at = to
    return out


def _hashes(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    at = np.cumsum(size) - size
    inner = np.arange(int(size.sum())) - np.repeat(at, size)
    terms = _BYTE[data[inner + np.repeat(start, size)]]
    terms *= _powers(int(size.max()))[inner]
    return mix(np.add.reduceat(terms, at) + size.astype(np.uint64) * _GOLDEN)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k values from each position; the last k - 1 positions have none."""
    n = max(len(hashes) - k + 1, 0)
    out = np.zeros(n, np.uint64)
    for j, weight in enumerate(mix((np.arange(k, dtype=np.uint64) + np.uint64(77)) * _GOLDEN) | np.uint64(1)):
        out += hashes[j : j + n] * weight
    return mix(out)


def slices(batches: Iterable[pa.RecordBatch], column: str, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of the batches with about `size` bytes of text each (one row at least): bounds the memory of numpy."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, bounds = bytes_of(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + size, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to
