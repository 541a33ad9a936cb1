"""Word shingles of many texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from feedplan.llm.words import Words, grams, mix, slices


def shingles(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of `size` words, and the text that each is of, in order of place.

    A text of fewer words (but one at least) has one shingle of all its words;
    null, empty and blank texts have none.
    """
    words = Words.of(texts)
    hashes = words.hashes()
    runs = grams(hashes, size)
    inside = words.doc[: len(runs)] == words.doc[len(words) - len(runs) :]
    values, docs = [runs[inside]], [words.doc[: len(runs)][inside]]
    counts = words.counts()
    first = np.cumsum(counts) - counts
    for n in range(1, size):
        short = np.flatnonzero(counts == n)
        if len(short):
            all_words = grams(hashes, n)[first[short]]
            values.append(mix(all_words + np.uint64(n)))
            docs.append(short)
    if len(values) == 1:
        return values[0], docs[0]
    value, doc = np.concatenate(values), np.concatenate(docs)
    order = np.argsort(doc, kind="stable")
    return value[order], doc[order]


def sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of many texts, in order of text, found in parts of bounded size."""
    values, docs, before = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    for part in slices([pa.record_batch([texts], ["t"])], "t"):
        value, doc = distinct(*shingles(part.column("t"), size))
        values.append(value)
        docs.append(doc + before)
        before += part.num_rows
    return np.concatenate(values), np.concatenate(docs)


def distinct(value: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The set of values of each text, in order of text and value."""
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    return value[new], doc[new]
