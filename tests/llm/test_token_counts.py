from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from feedplan.llm import token_counts
from feedplan.llm.token_counts import OUT, STATES, PieceMarks, compose

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    coder = Tokenizer.from_file(PATH)
    return lambda texts: [len(x.ids) for x in coder.encode_batch(texts, add_special_tokens=False)]


def test_equals_the_library(library):
    draw = random.Random(5)
    letters = "aéE日😀 \n'strevlmd-01#<|Σİ½²"
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 200))) for _ in range(400)]
    texts += ["a" * 3000, " " * 900, "", "'", "'r", "'l'll", "don't we'll they've i'm 'tis", "x<|endoftext|>y <|startoftext|><|endoftext|", "é <|endoftext|>́"]
    assert token_counts.counter(PATH)(texts).tolist() == library(texts)


def test_resets_change_nothing(library, monkeypatch):
    monkeypatch.setattr(token_counts, "COMPILED", 4)
    texts = ["one two three four five", "six seven one two", "eight one"]
    counter = token_counts.Counter(PATH)
    assert [int(counter([t])[0]) for t in texts] == library(texts)


def test_scan_composes_maps():
    draw = np.random.default_rng(1)
    maps = draw.integers(0, STATES, (37, STATES)).astype(np.uint8)
    state = np.arange(STATES)
    for i, row in enumerate(compose(maps)):
        state = maps[i][state]
        assert (row == state).all()


def test_marks_do_not_depend_on_chunks(monkeypatch):
    text = "it's a 'test' of they'r and we'll, 12 ab''s l'l " * 30
    points = np.array([ord(c) for c in text], np.uint32)
    whole = PieceMarks()(points)
    for size in (1, 2, 3, 7, 64):
        monkeypatch.setattr(token_counts, "CHUNK", size)
        parts = PieceMarks()(points)
        assert all((a == b).all() for a, b in zip(whole, parts, strict=True))
    assert OUT == 0


def test_rows(odd_docs, no_docs, library):
    out = token_counts.token_counts(odd_docs, PATH, limit=10).collect()
    texts = odd_docs.select("doc_id", "text").collect()
    counts = library([r.text or "" for r in texts])
    expected = [(r.doc_id, len((r.text or "").encode()), n, n > 10) for r, n in zip(texts, counts, strict=True)]
    assert sorted(map(tuple, out), key=str) == sorted(expected, key=str)
    assert token_counts.token_counts(no_docs, PATH).count() == 0
