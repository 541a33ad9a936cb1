"""Quality rules on repetition inside a document, by suffix arrays of words.

The suffixes of all texts of a batch are sorted together by prefix doubling
(texts apart, settled suffixes left alone). The common prefix of neighbours in
that order is the depth of the LCP intervals; the deepest interval of a suffix
gives the longest repeated run of words that starts there. These runs hold
every occurrence of every maximal repeated substring, and are occurrences of
one themselves, up to an extension to the left, so the union of their spans is
the union of the spans of the maximal repeats. A document fails when these
spans cover too much of it, or when one repeat is too long.

Defined results: null, empty and blank texts have no words and fail; equal
rows give equal results; lines that differ only in the bytes around their
words are different lines.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedplan.llm.words import Words, grams, slices, small_batches, span_hashes

#: Characters that count as symbols.
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Limits:
    """Words of the shortest repeat that counts; the share of words in repeats, and the words of one repeat, from which a text fails."""

    shortest: int = 8
    covered: float = 0.5
    longest: int = 200


def suffix_ranks(symbol: np.ndarray, doc: np.ndarray) -> list[np.ndarray]:
    """Ranks of the suffixes by their first 1, 2, 4, ... symbols, until all differ; suffixes of different texts always differ."""
    n = len(symbol)
    order = np.lexsort((symbol, doc))
    same = (symbol[order[1:]] == symbol[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = _group_starts(same)
    levels, reach = [rank], 1
    tied = np.zeros(n, bool)
    tied[:-1] |= same
    tied[1:] |= same
    active = order[tied]
    while len(active):
        after = active + reach
        inside = after < n
        inside[inside] = doc[after[inside]] == doc[active[inside]]
        follow = np.where(inside, rank[np.where(inside, after, 0)] + 1, 0)
        by = np.argsort(rank[active] * (n + 1) + follow, kind="stable")
        active, follow = active[by], follow[by]
        old = rank[active]
        kept = old[1:] == old[:-1]
        same = kept & (follow[1:] == follow[:-1])
        # the place of the first of a new group, counted from the first of its old group
        rank = rank.copy()
        rank[active] = old + _group_starts(same) - _group_starts(kept)
        levels.append(rank)
        reach *= 2
        tied = np.zeros(len(active), bool)
        tied[:-1] |= same
        tied[1:] |= same
        active = active[tied]
    return levels


def _group_starts(same: np.ndarray) -> np.ndarray:
    """For each place the first place of its group; same[i]: places i and i + 1 are in one group."""
    starts = np.zeros(len(same) + 1, np.int64)
    starts[1:] = np.where(same, 0, np.arange(1, len(same) + 1))
    return np.maximum.accumulate(starts)


def common_prefixes(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Symbols that the suffixes at a and at b have in common; they are of one text each pair, or have none."""
    n = len(levels[0])
    size = np.zeros(len(a), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        x, y = a + size, b + size
        inside = (x < n) & (y < n)
        same = inside.copy()
        same[inside] = levels[level][x[inside]] == levels[level][y[inside]]
        size += same << level
    return size


def longest_repeats(symbol: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each place the length of the longest run from there that occurs elsewhere in the text, overlaps included."""
    if not len(symbol):
        return np.zeros(0, np.int64)
    levels = suffix_ranks(symbol, doc)
    order = np.argsort(levels[-1], kind="stable")
    depth = np.zeros(len(symbol) + 1, np.int64)
    pairs = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]])
    depth[pairs + 1] = common_prefixes(levels, order[pairs], order[pairs + 1])
    out = np.empty(len(symbol), np.int64)
    out[order] = np.maximum(depth[:-1], depth[1:])
    return out


def covered(size: np.ndarray, least: int) -> np.ndarray:
    """Places that a run of at least this length covers; size[i] is the length of the run from i."""
    ends = np.where(size >= least, np.arange(len(size)) + size, 0)
    return np.maximum.accumulate(ends) > np.arange(len(size)) if len(size) else np.zeros(0, bool)


def _repeated(value: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether a value occurs at an earlier place of the same text, and whether it occurs there twice or more."""
    order = np.lexsort((value, doc))
    same = (value[order[1:]] == value[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
    out = np.zeros((2, len(value)), bool)
    out[0][order[1:]] = same
    out[1][order[1:]] = same
    out[1][order[:-1]] |= same
    return out


def measure(texts: pa.Array, limits: Limits) -> dict[str, np.ndarray]:
    """The measures and the verdict of each text."""
    words = Words.of(texts)
    rows, data = len(texts), words.data
    total = lambda x, at: np.bincount(at, weights=x, minlength=rows).astype(np.int64)
    n_words = words.counts()
    # code points: bytes that are not continuation bytes
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
    out = {
        "n_words": n_words,
        "word_chars": total(heads[words.end] - heads[words.start], words.doc),
        "n_symbols": symbols[words.bounds[1:]] - symbols[words.bounds[:-1]],
        "n_dup_lines": _dup_lines(words, rows),
    }
    hashes = words.hashes()
    runs = grams(hashes, 3)
    inside = np.flatnonzero(words.doc[: len(runs)] == words.doc[len(words) - len(runs) :])
    twice = np.zeros(len(words) + 3, bool)
    for at in (first := inside[_repeated(runs[inside], words.doc[inside])[1]], first + 1, first + 2):
        twice[at] = True
    out["n_repeat_words"] = total(twice[: len(words)], words.doc)
    out["base_failed"] = (n_words < 50) | (100 * out["n_repeat_words"] > 50 * n_words)
    _, symbol = np.unique(hashes, return_inverse=True)
    size = longest_repeats(symbol, words.doc)
    out["n_covered"] = total(covered(size, limits.shortest), words.doc)
    out["longest_repeat"] = np.zeros(rows, np.int64)
    np.maximum.at(out["longest_repeat"], words.doc, size)
    too_much = (out["n_covered"] > limits.covered * n_words) | (out["longest_repeat"] > limits.longest)
    out["kept"] = ~out["base_failed"] & ~too_much
    return out


def _dup_lines(words: Words, rows: int) -> np.ndarray:
    """Lines with a word that equal an earlier line of the text."""
    data, bounds = words.data, words.bounds
    if not len(words):
        return np.zeros(rows, np.int64)
    feeds = np.flatnonzero(data == 0x0A)
    start = np.unique(np.concatenate([bounds[:-1], feeds + 1]))
    start = start[start < len(data)]
    end = np.concatenate([start[1:], [len(data)]])
    doc = np.searchsorted(bounds, start, "right") - 1
    end = end - (data[end - 1] == 0x0A)  # the line feed itself does not count
    first_word = np.searchsorted(words.start, start)
    first_word[first_word == len(words)] = len(words) - 1
    filled = (words.start[first_word] >= start) & (words.start[first_word] < end)
    start, end, doc = start[filled], end[filled], doc[filled]
    again = _repeated(span_hashes(data, start, end), doc)[0]
    return np.bincount(doc, weights=again, minlength=rows).astype(np.int64)


_FIELDS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, n_covered bigint, longest_repeat bigint, kept boolean"


def repetition(text: Column, limits: Limits | None = None) -> Column:
    """Struct of all measures and the verdict `kept`."""
    limits = limits or Limits()

    @F.arrow_udf(f"struct<{_FIELDS.replace(' ', ':').replace(',:', ',')}>")
    def rules(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out = []
            for part in slices([pa.record_batch([texts], ["t"])], "t", 1 << 20):
                found = measure(part.column("t"), limits)
                out.append(pa.StructArray.from_arrays([pa.array(v if v.dtype == bool else v.astype(np.int64)) for v in found.values()], list(found)))
            yield pa.concat_arrays(out)

    return rules(text)


def verdicts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", limits: Limits | None = None) -> DataFrame:
    """One row per document. Nothing is shuffled."""
    small_batches(docs.sparkSession)
    return docs.select(id_column, repetition(F.col(text_column), limits).alias("__r")).select(id_column, "__r.*")
