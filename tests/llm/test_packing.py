"""Packing: ids against the library, patterns against a packing piece by piece, and the whole against its contract."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from feedplan.llm import packing
from tests.llm.conftest import documents

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    coder = Tokenizer.from_file(PATH)
    return lambda texts: [x.ids for x in coder.encode_batch(texts, add_special_tokens=False)]


def one_by_one(lengths, size):
    """Worst fit decreasing, one piece at a time."""
    packs = []
    for length in sorted(lengths, reverse=True):
        free = max(packs, default=0)
        if free >= length:
            packs.remove(free)
            packs.append(free - length)
        else:
            packs.append(size - length)
    return sorted(packs)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120))
def test_patterns_equal_a_packing_piece_by_piece(lengths):
    patterns = packing.shortest_pack_first(Counter(lengths), 40)
    assert sorted(40 - p.fill() for p in patterns for _ in range(p.count)) == one_by_one(lengths, 40)
    assert Counter({k: v for k, v in Counter(lengths).items()}) == sum((Counter({a: t * p.count}) for p in patterns for a, t in p.runs), Counter())


def test_every_rank_has_its_own_place():
    draw = random.Random(2)
    lengths = Counter(int(draw.expovariate(1 / 30)) % 99 + 1 for _ in range(3000))
    patterns = packing.shortest_pack_first(lengths, 100)
    slots = packing.Slots.of(patterns)
    length = np.repeat(list(lengths), list(lengths.values()))
    rank = np.concatenate([np.arange(n) for n in lengths.values()])
    sequence, offset = slots(length, rank)
    order = np.lexsort((offset, sequence))
    sequence, offset, ends = sequence[order], offset[order], (offset + length)[order]
    new = np.append(True, sequence[1:] != sequence[:-1])
    assert (offset[new] == 0).all() and (offset[1:][~new[1:]] == ends[:-1][~new[1:]]).all() and ends.max() <= 100


def test_work_does_not_grow_with_the_counts():
    few = packing.shortest_pack_first({n: 3 for n in range(1, 4097)}, 4096)
    many = packing.shortest_pack_first({n: 3 * 10**9 + n for n in range(1, 4097)}, 4096)
    assert len(many) < 20 * len(few) < 1_000_000 and packing.padding(many, 4096) < 0.01 * 4096 * sum(p.count for p in many)


def test_a_length_that_does_not_fit():
    with pytest.raises(ValueError, match="does not fit"):
        packing.shortest_pack_first({41: 1}, 40)


TEXTS = [
    "", "Hello, World's 42!", "a\x1cb \x1d c", "\u00c9 e\u0301 \u0301x", "x\u2003y\u3000z\x85w", "\u0391\u03a3 \u03a3 \u039f\u0394\u039f\u03a3",
    "<|endoftext|>a b<|startoftext|>", "\u0130stanbul \ufb01 \u01c5", "\U0001f600 \u200b\u180e\ufeff\x00 \u65e5\u672c",
]


@pytest.mark.parametrize("text", TEXTS)
def test_ids_are_those_of_the_library(library, text):
    texts = [text, None, text + " " + text]
    ids, counts = packing.word_ids(PATH)(pa.array(texts))
    expected = library([t or "" for t in texts])
    assert counts.tolist() == [len(x) for x in expected] and ids.tolist() == sum(expected, [])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("aB's\u00e9e\u0301\u0300\u03a3\u03c3\u0130\x1c\x1f\x85\xa0\u2028\u0345 1<|>endoftext\U0001f600\uac01\u1100\r\n"), max_size=40), max_size=3))
def test_no_text_differs_from_the_library(library, texts):
    ids, counts = packing.word_ids(PATH)(pa.array(texts, pa.string()))
    expected = library(texts)
    assert counts.tolist() == [len(x) for x in expected] and ids.tolist() == sum(expected, [])


def check(rows, docs, library, size=4096):
    """Rows are of `packed`, docs are (id, text); ids may repeat where texts do."""
    expected = Counter()
    for (id_, _), ids in zip(docs, library([t or "" for _, t in docs]), strict=True):
        ids = [*ids, 2]
        for start in range(0, len(ids), size):
            part = ids[start : start + size]
            expected[id_, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == expected
    spans: dict = {}
    for r in rows:
        spans.setdefault(r.sequence_id, []).append((r.offset, r.offset + r.length))
    assert sorted(spans) == list(range(len(spans)))
    for own in spans.values():
        own.sort()
        assert [b for b, _ in own] == [0, *(e for _, e in own[:-1])] and own[-1][1] <= size
    return spans


def test_whole_table(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for size in (4096, 64):
        spans = check(packing.packed(docs, PATH, size).collect(), [(r.doc_id, r.text) for r in docs.collect()], library, size)
        used = sum(own[-1][1] for own in spans.values())
        assert used > (len(spans) - 2) * size * 0.99


def test_a_third_of_one_length(spark, library):
    texts = ["the same text"] * 300 + [f"word {i} " * (i % 50) for i in range(600)]
    docs = documents(spark, texts)
    check(packing.packed(docs, PATH, 64).collect(), list(enumerate(texts)), library, 64)


def test_odd_rows(spark, odd_docs, no_docs, library):
    rows = packing.packed(odd_docs, PATH).collect()
    check(rows, [(r.doc_id, r.text) for r in odd_docs.collect()], library)
    assert packing.packed(no_docs, PATH).collect() == []
    named = odd_docs.selectExpr("concat('d', doc_id) as doc_id", "text")
    assert {r.doc_id for r in packing.packed(named, PATH).collect()} >= {"d1", "d9", None}
