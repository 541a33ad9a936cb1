from __future__ import annotations

import random
import re

import pytest

from feedplan.llm import decontaminate
from feedplan.llm.decontaminate import ITEM_COST, leaks, sketch_size, with_leaks
from tests.llm.conftest import documents


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def by_hand(docs, items, threshold=0.8):
    out = set()
    for d, text in docs:
        for i, item in items:
            a, b = shingle_set(text), shingle_set(item)
            if i is not None and b and len(a & b) >= threshold * len(b) - 1e-9:
                out.add((d, i, len(a & b), len(b)))
    return out


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(3)
    fresh = lambda n: [f"w{draw.randint(0, 300)}" for _ in range(n)]
    items = [(i, " ".join(fresh(draw.randint(1, 70)))) for i in range(40)] + [(90, None), (91, " "), (None, "w1 w2 w3 w4 w5 w6")]
    items += [(92, items[0][1]), (93, "w1 w2")]
    docs = []
    for i in range(80):
        w = fresh(draw.randint(0, 200))
        if i % 2:
            part = draw.choice(items[:40])[1].split()
            for _ in range(draw.choice([0, 0, 1, 3])):
                part[draw.randrange(len(part))] = "x"
            w[len(w) // 2 : len(w) // 2] = part
        docs.append((i, " ".join(w)))
    return docs + [(100, None), (101, ""), (102, "w1 w2"), (103, items[5][1].replace(" ", "\n"))], items


@pytest.mark.parametrize("limit", [8_000_000, 0])
def test_equals_brute_force(spark, corpus, limit):
    docs, items = corpus
    out = leaks(
        spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3),
        spark.createDataFrame(items, "item_id bigint, text string"),
        index_limit=limit,
    )
    got = [(r.doc_id, r.item_id, r.n_shared, r.n_shingles) for r in out.collect()]
    assert len(got) == len(set(got))
    assert set(got) == by_hand(docs, items)


@pytest.mark.parametrize("limit", [8_000_000, 0])
def test_repeated_item_ids(spark, limit):
    a, b = (" ".join(f"{x}{i}" for i in range(20)) for x in "ab")
    items = [(1, a), (1, a), (1, b), (2, b), (2, b), (2, b)]
    docs = [(10, a), (11, f"before {b} after"), (12, f"{a} {b}"), (13, "none of them at all")]
    out = leaks(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string").repartition(3), index_limit=limit
    )
    expected = [(d, i, 16, 16) for d, text in docs for i, item in items if item in text]
    assert sorted((r.doc_id, r.item_id, r.n_shared, r.n_shingles) for r in out.collect()) == sorted(expected)


def test_many_short_items_are_no_broadcast(spark, monkeypatch):
    """Rows count against the limit, not only characters; items without words cost nothing."""
    taken = []
    by_joins, by_broadcast = decontaminate._by_joins, decontaminate._by_broadcast
    monkeypatch.setattr(decontaminate, "_by_joins", lambda *a: taken.append("joins") or by_joins(*a))
    monkeypatch.setattr(decontaminate, "_by_broadcast", lambda *a: taken.append("broadcast") or by_broadcast(*a))
    docs = spark.createDataFrame([(1, "w1"), (2, "w1 w2")], "doc_id bigint, text string")
    short = spark.createDataFrame([(i, f"w{i}") for i in range(100)], "item_id bigint, text string")
    blank = spark.createDataFrame([(i, " \t" * (i % 3)) for i in range(5000)], "item_id bigint, text string")
    for items, limit in ((short, 50 * ITEM_COST), (short, 110 * ITEM_COST), (blank, 0), (short.unionByName(blank), 110 * ITEM_COST)):
        found = {(r.doc_id, r.item_id) for r in leaks(docs, items, index_limit=limit).collect()}
        assert found == ({(1, 1)} if items is not blank else set())
    assert taken == ["joins", "broadcast", "broadcast", "broadcast"]


def test_no_python_row_by_row(spark):
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id bigint, text string")
    plan = leaks(documents(spark, ["a b c d e f"]), items, index_limit=0)._jdf.queryExecution().toString()
    assert "BatchEvalPython" not in plan and "Window" not in plan


def test_sketches_cannot_miss_short_items():
    for n in range(1, 65):
        assert sketch_size(n, 0.8, 1e-9) >= min(n, int(0.2 * n) + 1)
    assert sketch_size(10_000, 0.8, 1e-9) <= 13


@pytest.mark.parametrize("limit", [8_000_000, 0])
def test_rows(spark, odd_docs, no_docs, limit):
    items = spark.createDataFrame([(1, "the same words in a row that repeats itself"), (2, "x" * 5_000)], "item_id bigint, text string")
    out = with_leaks(odd_docs, items, column="found", index_limit=limit)
    assert out.columns == [*odd_docs.columns, "found"] and out.count() == odd_docs.count()
    assert sorted((r.doc_id, [x.item_id for x in r.found]) for r in out.collect() if r.found) == [(7, [1]), (7, [1]), (9, [2])]
    assert leaks(no_docs, items, index_limit=limit).count() == 0
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert leaks(documents(odd_docs.sparkSession, ["a b c d e f"]), none, index_limit=limit).count() == 0
