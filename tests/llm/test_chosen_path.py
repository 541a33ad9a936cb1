from __future__ import annotations

import random
import re
from collections import defaultdict

import corpus_pipeline
import numpy as np

from feedplan.llm import chosen_path
from feedplan.llm.chosen_path import Paths, joined
from feedplan.llm.components import components
from tests.llm.conftest import documents


def by_hand(rows, threshold=0.8):
    """{place: (least id of the group, links)} of rows (id, text)."""
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(rows)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j and a and b and len(a & b) >= threshold * len(a | b) - 1e-9:
                links[i] += 1
                parent[max(root(i), root(j))] = min(root(i), root(j))
    least = defaultdict(list)
    for i, (id_, _) in enumerate(rows):
        least[root(i)].append(id_)
    return [(min((x for x in least[root(i)] if x is not None), default=None), links[i]) for i in range(len(rows))]


def some_texts(seed, n=40, group=30):
    draw = random.Random(seed)
    fresh = lambda k: [f"w{draw.randint(0, 400)}" for _ in range(k)]
    passage = fresh(30)
    texts = [None, "", " \n", "short one", "short one"]
    for _ in range(n):
        base = fresh(draw.randint(1, 150))
        for _ in range(draw.choice([1, 1, 2, 5])):
            w = list(base)
            for _ in range(draw.choice([0, 0, 1, 2, 6])):
                w[draw.randrange(len(w))] = f"x{draw.randint(0, 9)}"
            texts.append(" ".join(w))
        texts.append(" ".join(fresh(20) + passage + fresh(20)))
    large = fresh(200)
    for _ in range(group):
        w = list(large)
        w[draw.randrange(len(w))] = f"y{draw.randint(0, 99)}"
        texts.append(" ".join(w))
    return texts


def check(spark, texts, paths):
    out = {r.doc_id: (r.class_id, r.n_links) for r in joined(documents(spark, texts), paths=paths).collect()}
    assert [out[i] for i in range(len(texts))] == by_hand(list(enumerate(texts)))


def test_equals_brute_force(spark):
    check(spark, some_texts(1), Paths())


def test_deep_paths_and_blocks(spark):
    # buckets of three sets at most are compared, others are split to the last level; groups are verified in blocks of eight
    check(spark, some_texts(2), Paths(bucket=3, block=8))
    check(spark, some_texts(3, n=5), Paths(bucket=3, block_shingles=1000))


def test_blocks_with_an_empty_part(spark):
    # groups of two, three and four in two or more parts: some parts have no members
    texts = []
    for i in range(12):
        w = [f"g{i}w{j}" for j in range(60)]
        texts += [" ".join([*w, f"e{k}"]) for k in range(2 + i % 3)]
    check(spark, texts, Paths(block_shingles=100))


def test_one_text_of_each_set_is_verified(spark, monkeypatch):
    w = [f"w{j}" for j in range(60)]
    texts = [" ".join(w)] * 40 + [" ".join([*w, "end"])]
    verified, rows = chosen_path._verified, []

    def counted(blocks, paths):
        rows.append(blocks.count())
        return verified(blocks, paths)

    monkeypatch.setattr(chosen_path, "_verified", counted)
    check(spark, texts, Paths())
    assert rows == [2]


def test_recall_of_pairs_at_the_threshold(spark):
    draw = random.Random(7)
    texts = []
    for i in range(150):
        base = [f"p{i}q{j}" for j in range(104)]  # 100 shingles; two changes near the ends leave 88 of 112
        texts += [" ".join(base), " ".join(base[:11] + ["a"] + base[12:-11] + ["b"] + base[-10:])]
        draw.random()
    out = joined(documents(spark, texts), paths=Paths(threshold=0.75)).collect()
    expected = by_hand(list(enumerate(texts)), 0.75)
    found = sum(r.n_links for r in out)
    assert found >= 0.99 * sum(n for _, n in expected) > 0


def test_recall_at_the_threshold_through_all_levels(spark):
    # 80 of 100 shingles shared; no bucket is small enough to be compared, so every pair has to meet at each level
    base = [[f"p{i}q{j}" for j in range(104)] for i in range(2000)]
    texts = [" ".join(w[:n]) for w in base for n in (104, 84)]
    out = joined(documents(spark, texts), paths=Paths(bucket=1)).collect()
    assert sum(r.n_links for r in out) / len(texts) >= 0.997


def test_more_runs_for_more_recall():
    assert Paths(recall=0.9).runs() < Paths().runs() < Paths(recall=0.99999).runs()


def test_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    expected = [(id_, *x) for (id_, _), x in zip(rows, by_hand(rows), strict=True)]
    out = [(r.doc_id, r.class_id, r.n_links) for r in joined(odd_docs).collect()]
    assert sorted(out, key=str) == sorted(expected, key=str)
    assert joined(no_docs).count() == 0


def test_rows_without_ids_join_the_groups_of_others(spark):
    base = [f"w{i}" for i in range(60)]
    rows = [(None, " ".join(base)), (9, " ".join([*base[:-1], "x"])), (4, " ".join(["y", *base[1:]])), (None, "alone with five words"), (None, " ".join([*base, "z"]))]
    out = joined(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    expected = [(id_, *x) for (id_, _), x in zip(rows, by_hand(rows), strict=True)]
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in out), key=str) == sorted(expected, key=str)
    assert {r.class_id for r in out} == {4, None}


def test_components(spark):
    draw = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in draw.integers(-20, 60, (45, 2))] + [(i, i + 1) for i in range(100, 140)]
    label = {n: n for e in edges for n in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {n: r for n, r in label.items() if any(n in e and e[0] != e[1] for e in edges)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_ids_at_both_ends(spark):
    """Any integer may be an id; no document is lost, and none has a group without a name but those without any id."""
    text, near = " ".join(f"w{i}" for i in range(60)), " ".join(f"w{i}" for i in range(59))
    rows = [
        ((1 << 63) - 1, text), (1 << 62, near), (-(1 << 63), "alone here"), ((1 << 62) + 5, "quite another text of some words"), (None, near + " w59"),
        (None, "nobody knows this one"), (None, "nobody knows this one"), ((1 << 61) + 1, "alone here"), (None, None), (-1, ""),
    ]
    found = joined(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(found) == len(rows)
    assert {r.doc_id: r.class_id for r in found if r.doc_id is not None} == {
        (1 << 63) - 1: 1 << 62, 1 << 62: 1 << 62, -(1 << 63): -(1 << 63), (1 << 62) + 5: (1 << 62) + 5, (1 << 61) + 1: -(1 << 63), -1: -1,
    }
    assert sorted((r.class_id or 0, r.n_links) for r in found if r.doc_id is None) == [(0, 0), (0, 1), (0, 1), (1 << 62, 2)]
    stay = corpus_pipeline.near_duplicates(spark, spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint"), "")
    kept = [r.doc_id for r in stay.collect()]
    # of the first group the row without an id stays, of the two that nobody knows one, and the row without a text
    assert sorted(k for k in kept if k is not None) == [-(1 << 63), -1, (1 << 62) + 5] and kept.count(None) == 3
