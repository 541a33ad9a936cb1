from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from feedplan.llm import substring_dedup
from feedplan.llm.fm_index import FMIndex
from feedplan.llm.substring_dedup import Units, deduplicated
from tests.llm.conftest import documents


def by_hand(texts, width):
    all_words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(w[i : i + width]) for w in all_words for i in range(len(w) - width + 1))
    out = []
    for w in all_words:
        gone = {i + j for i in range(len(w) - width + 1) if seen[tuple(w[i : i + width])] > 1 for j in range(width)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def some_texts(seed):
    draw = random.Random(seed)
    fresh = lambda n: [f"w{draw.randint(0, 5000)}" for _ in range(n)]
    passages = [fresh(draw.randint(8, 40)) for _ in range(8)]
    texts = [None, "", " \n", "a a a", "z " * 60]
    for _ in range(60):
        w = fresh(draw.randint(0, 60))
        for _ in range(draw.randint(0, 3)):
            at, p = draw.randint(0, len(w)), list(draw.choice(passages))
            if draw.random() < 0.5:
                p[draw.randint(0, len(p) - 1)] = "changed"
            w[at:at] = p
        texts.append(draw.choice([" ", "\n", " \t"]).join(w))
    return texts + texts[10:14] + [texts[20]] * 5


def test_equals_brute_force(spark):
    for seed, width in ((1, 10), (2, 12)):
        texts = some_texts(seed)
        out = {r.doc_id: tuple(r)[1:] for r in deduplicated(documents(spark, texts), width=width).collect()}
        assert [out[i] for i in range(len(texts))] == by_hand(texts, width)


def test_hot_anchors_and_small_shards(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT", 2)
    texts = some_texts(3)
    out = {r.doc_id: tuple(r)[1:] for r in deduplicated(documents(spark, texts), width=10).collect()}
    assert [out[i] for i in range(len(texts))] == by_hand(texts, 10)


def test_shards_of_a_hot_line_hold_one_window():
    # windows that begin inside the line have its anchor and differ behind it
    line = " ".join(f"l{i}" for i in range(30))
    texts = [" ".join([*(f"a{k}b{i}" for i in range(10)), line, *(f"c{k}d{i}" for i in range(30))]) for k in range(50)]
    units = Units(pa.array(texts + texts[:5], pa.string()), 35)
    units.part(np.ones(len(units.anchor), bool))
    windows = set(zip(units.anchor.tolist(), units.ids().tolist(), strict=True))
    assert len(windows) == len({shard for shard, _ in windows}) == len({unit for _, unit in windows})


def test_index_counts_and_matches():
    draw = np.random.default_rng(2)
    units = [draw.integers(0, 6, draw.integers(1, 25)) for _ in range(30)]
    weight = draw.integers(1, 3, 30)
    sizes = np.array([len(u) for u in units])
    index = FMIndex(np.concatenate(units).astype(np.uint64), sizes, weight)

    def occurrences(run):
        return sum(int(w) * sum(tuple(u[i : i + len(run)]) == tuple(run) for i in range(len(u) - len(run) + 1)) for u, w in zip(units, weight, strict=True))

    ends = index.first + sizes
    for least in (1, 2, 5):
        got = index.matched(ends, sizes, least)
        for u, n in zip(units, got, strict=True):
            assert all(occurrences(u[len(u) - k :]) >= least for k in range(1, n + 1))
            assert n == len(u) or occurrences(u[len(u) - n - 1 :]) < least
    windows = {(int(u), s) for a, b, c in index.repeated_windows(4) for u, x, y in zip(a, b, c, strict=True) for s in range(x, y + 1)}
    assert windows == {(i, s) for i, u in enumerate(units) for s in range(len(u) - 3) if occurrences(u[s : s + 4]) >= 2}


def test_rows(odd_docs, no_docs):
    rows = odd_docs.select("doc_id", "text").collect()
    expected = [(r.doc_id, *x) for r, x in zip(rows, by_hand([r.text for r in rows], 35), strict=True)]
    assert sorted(map(tuple, deduplicated(odd_docs).collect()), key=str) == sorted(expected, key=str)
    assert deduplicated(no_docs).count() == 0
