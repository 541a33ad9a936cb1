"""Alignment against a plain one: groups by common ends, links by overlap, counts over all documents."""

from __future__ import annotations

import bisect
import hashlib
import json
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from feedplan.llm import alignment
from feedplan.llm.token_counts import _byte_letters
from tests.llm.conftest import documents

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
LETTERS = "ab \n\r\té▁\xa0 \x85\x1c;,'s{}<0x41>日\U0001f600 \x00́ the of"


@pytest.fixture(scope="module")
def plain():
    """For each text the token bytes and ids of both tokenizers, by the libraries on the whole text."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = _byte_letters()
    names = {i: t for t, i in json.load(open(A, encoding="utf-8"))["model"]["vocab"].items()}

    def spelled(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    def tokens(text):
        if not text:
            return [], []
        x = [(i, bytes(letters[c] for c in names[i])) for i in a.encode(" " + text, add_special_tokens=False).ids]
        y = [(i, spelled(i)) for i in b.encode(text)]
        whole = (" " + text).encode()
        return (x, y) if b"".join(t for _, t in x) == whole == b"".join(t for _, t in y) else ([], [])

    return tokens


def ends(tokens):
    return np.cumsum([len(t) for _, t in tokens]).tolist()


def by_hand(texts, tokens):
    rows = []
    for text in texts:
        x, y = tokens(text)
        ex, ey = ends(x), ends(y)
        both = sorted(set(ex) & set(ey))
        groups = [([], []) for _ in both]
        for side, own, its in ((0, x, ex), (1, y, ey)):
            for (i, _), e in zip(own, its, strict=True):
                groups[bisect.bisect_left(both, e)][side].append(str(i))
        groups = [",".join(g) + "|" + ",".join(h) for g, h in groups]
        links, p = [], 0
        for k, (i, t) in enumerate(x):
            while p < len(y) and ey[p] <= ex[k] - len(t):
                p += 1
            q = p
            while q < len(y) and ey[q] - len(y[q][1]) < ex[k]:
                links.append((i, y[q][0]))
                q += 1
        rows.append((len(x), len(y), len(groups), links, ";".join(groups)))
    held = Counter(link for r in rows for link in set(r[3]))
    most = {}
    for (i, _), n in held.items():
        most[i] = max(most.get(i, 0), n)
    return [
        (a, b, g, len(links), sum(held[x] == most[x[0]] for x in links), sum(held[x] for x in links), hashlib.sha256(s.encode()).hexdigest() if s else "")
        for a, b, g, links, s in rows
    ]


def values(rows):
    return [(r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in rows]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 60)), st.lists(st.integers(1, 60)), st.lists(st.integers(61, 500)))
def test_links_and_groups(one, two, common):
    one, two = sorted({*one, *common, 600}), sorted({*two, *common, 600})
    a, b, group = alignment.align(one, two)
    begin = lambda e, i: e[i - 1] if i else 0
    overlap = [(i, j) for i in range(len(one)) for j in range(len(two)) if max(begin(one, i), begin(two, j)) < min(one[i], two[j])]
    assert list(zip(a.tolist(), b.tolist(), strict=True)) == overlap
    both = sorted(set(one) & set(two))
    assert group.tolist() == [sum(e < min(one[i], two[j]) for e in both) for i, j in overlap]


def test_long_stretches_are_jumped():
    class Counted(list):
        asked = 0

        def __getitem__(self, at):
            Counted.asked += 1
            return list.__getitem__(self, at)

    n = 200_000
    a, b, group = alignment.align(Counted(range(1, n)), Counted(range(1, n)))
    assert (a == b).all() and len(a) == n - 1 and Counted.asked < 200


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from(LETTERS), max_size=30)), max_size=4))
def test_parts_are_tokenized_like_whole_texts(plain, texts):
    found = alignment.aligner(A, B)(pa.array(texts, pa.string()))
    expected = by_hand(texts, plain)
    assert list(zip(*(found[c].tolist() for c in alignment._OWN), found["groups_sha256"], strict=True)) == [(*r[:4], r[6]) for r in expected]


@pytest.mark.parametrize("size", [alignment.SLICE, 2000])
def test_whole_table(spark, plain, monkeypatch, size):
    monkeypatch.setattr(alignment, "SLICE", size)
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(3)
    rows = sorted(alignment.aligned(docs, A, B).collect(), key=lambda r: r.doc_id)
    texts = [r.text for r in sorted(docs.collect(), key=lambda r: r.doc_id)]
    assert values(rows) == by_hand(texts, plain)


def test_copies_and_ties(spark, plain):
    texts = ["a very common line"] * 60 + ["unusual wording here", "a very uncommon line", "a▁b", "", " ", "a  b ", None]
    rows = sorted(alignment.aligned(documents(spark, texts), A, B).collect(), key=lambda r: r.doc_id)
    assert values(rows) == by_hand(texts, plain)


def test_odd_rows(spark, odd_docs, no_docs, plain):
    rows = alignment.aligned(odd_docs, A, B).collect()
    docs = odd_docs.collect()
    assert sorted((r.doc_id or 0, *v) for r, v in zip(rows, values(rows), strict=True)) == sorted((d.doc_id or 0, *v) for d, v in zip(docs, by_hand([d.text for d in docs], plain), strict=True))
    assert alignment.aligned(no_docs, A, B).collect() == []
    named = odd_docs.selectExpr("concat('d', doc_id) as doc_id", "text")
    assert {r.doc_id for r in alignment.aligned(named, A, B).collect()} >= {"d1", "d9", None}


def test_a_long_text_without_blanks(plain):
    text = "".join(f"x{i}" for i in range(20_000)) + "\t" * 3000 + " " * 3000
    found = alignment.aligner(A, B)(pa.array([text]))
    assert found["groups_sha256"] == [by_hand([text], plain)[0][6]]


def test_tasks_that_answer_hold_few_slices(spark, monkeypatch):
    monkeypatch.setattr(alignment, "ANSWERED", 2)
    docs = documents(spark, [f"text {i} with some words" for i in range(200)]).repartition(12)  # a slice each
    found = alignment.aligned(docs, A, B)
    assert found.count() == 200
    plan = found._jdf.queryExecution().executedPlan().toString()
    tasks = {int(n) for n in re.findall(r"hashpartitioning\((?:slice|of)#\d+L?, (\d+)\), REPARTITION_BY_NUM", plan)}
    assert tasks == {6}, plan


def test_workers_that_answer_forget_the_parts():
    aligner = alignment.aligner(A, B)
    found = aligner(pa.array(["one text"]))
    whole = {c: pa.array([found[c].tolist()], pa.list_(pa.int64())) for c in (*alignment._OWN, "n_parts")}
    binary = {c: pa.array([found[c].tobytes()]) for c in ("parts", "links", "link_sizes")}
    rows = pa.table({"id": pa.array([[1]]), "groups_sha256": pa.array([found["groups_sha256"]]), **whole, **binary})
    counts = pa.table({"code": found["codes"].astype(np.int64), "count": found["docs"], "best": np.ones(len(found["docs"]), np.int32)})
    answer = alignment._answered(rows, counts)
    assert answer["count_sum"].to_pylist() == answer["n_links"].to_pylist() == found["n_links"].tolist()
    assert alignment.aligner.cache_info().currsize == 0
