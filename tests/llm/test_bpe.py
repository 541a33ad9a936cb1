from __future__ import annotations

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedplan.llm import bpe, words

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aé日😀 \n'sta-01#<|the ing", max_size=80))
def test_equals_the_library(library, text):
    coder = bpe.encoder(PATH, PATTERN)
    groups = coder.encode([text, "", text])
    assert [" ".join(g) for g in groups] == [" ".join(map(str, library.encode_ordinary(t))) for t in (text, "", text)]
    assert coder.decode(groups) == [text.encode(), b"", text.encode()]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(max_codepoint=0xFF), max_size=60))
def test_both_engines_cut_alike(library, text):
    coder = bpe.encoder(PATH, PATTERN)
    assert coder.pieces(text) == coder._pieces(text)
    assert " ".join(coder.encode([text])[0]) == " ".join(map(str, library.encode_ordinary(text)))


def test_every_latin_character_is_cut_alike(library):
    coder = bpe.encoder(PATH, PATTERN)
    for c in map(chr, range(256)):
        for text in (c, f"a{c}b", f" {c}{c} 1{c}", f"'{c}s{c}'s", f"_{c}_"):
            assert coder.pieces(text) == coder._pieces(text)
            assert " ".join(coder.encode([text])[0]) == " ".join(map(str, library.encode_ordinary(text)))


def test_long_pieces(library):
    texts = ["a" * 3000, " " * 700, "ab" * 900, "<|endoftext|>", "\x00\x01\xa0　ß"]
    lines = [" ".join(g) for g in bpe.encoder(PATH, PATTERN).encode(texts)]
    assert lines == [" ".join(map(str, library.encode_ordinary(t))) for t in texts]


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    coder = bpe.Encoder(PATH, PATTERN)
    texts = ["one two three four", "five six one", "two five seven"]
    for some in (texts, texts[:1], texts[1:]):
        assert [" ".join(g) for g in coder.encode(some)] == [" ".join(map(str, library.encode_ordinary(t))) for t in some]


def test_append_and_edit_equal_encoding_anew():
    merges = bpe.encoder(PATH, PATTERN).merges
    draw = random.Random(4)
    for _ in range(150):
        text = "".join(draw.choice("the tion aé'ing") for _ in range(60)).encode()
        table = bpe.PrefixTable(merges, text[:20]).append(text[20:])
        assert table.tokens() == bpe.PrefixTable(merges, text).tokens()
        a = draw.randint(0, len(text))
        b, new = min(len(text), a + draw.randint(0, 5)), draw.choice([b"", b"x", b"ing"])
        assert table.edit(a, b, new).tokens() == bpe.PrefixTable(merges, text[:a] + new + text[b:]).tokens()


def test_rows(spark, library, odd_docs, no_docs):
    out = bpe.token_digests(odd_docs, PATH, PATTERN).collect()
    expected = []
    for r in odd_docs.select("doc_id", "text").collect():
        ids = library.encode_ordinary(r.text or "")
        line = " ".join(map(str, ids))
        expected.append((r.doc_id, len(ids), hashlib.sha256(line.encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert sorted(map(tuple, out), key=str) == sorted(expected, key=str)
    assert bpe.token_digests(no_docs, PATH, PATTERN).count() == 0


def test_ids_decode_to_the_text(odd_docs):
    ids = odd_docs.select("text", bpe.encoded(F.col("text"), PATH, PATTERN).alias("ids"))
    for r in ids.select("text", bpe.decoded(F.col("ids"), PATH, PATTERN).alias("back")).collect():
        assert bytes(r.back) == (r.text or "").encode()


def test_words_match_the_pattern():
    import re

    import pyarrow as pa

    texts = ["a b", None, "", " x\x0b\x0cy ", "é b\x85 c\n", "end", "next"]
    found = words.Words.of(pa.array(texts))
    got = [bytes(found.data[s:e]).decode() for s, e in zip(found.start, found.end, strict=True)]
    assert got == [w for t in texts for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
    assert found.counts().tolist() == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]
    hashes = found.hashes()
    assert len(set(hashes.tolist())) == len(set(got))
    for part in (1, 3, 10):
        assert (words.span_hashes(found.data, found.start, found.end, part) == hashes).all()
