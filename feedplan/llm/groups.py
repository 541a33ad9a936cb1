"""Rows that come ordered by a key, handed on in whole groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from feedplan.llm.words import bytes_of


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, size: int, text: str | None = None) -> Iterator[pa.Table]:
    """Tables of whole groups with about `size` rows, or bytes of `text`; a larger group comes alone."""
    held: list[pa.RecordBatch] = []
    filled, last = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        bounds = bytes_of(batch.column(text))[1] if text else np.arange(len(keys) + 1)
        begins = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]]).tolist()
        at = 0
        for begin, end in zip(begins, begins[1:], strict=False):
            if filled >= size and keys[begin] != last:
                held.append(batch.slice(at, begin - at))
                yield pa.Table.from_batches(held)
                held, filled, at = [], 0, begin
            filled += int(bounds[end] - bounds[begin])
            last = keys[begin]
        held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held)
