"""Hard negatives against brute force; the product of tiles against numpy."""

from __future__ import annotations

import math

import numpy as np
import pytest

from feedplan.llm import hard_negatives as hn

SCHEMA = "vec_id bigint, embedding array<float>, label int, `id` string, `vector` string, `number` int, `ids` string"


def by_hand(rows):
    """Rows are (vec_id, embedding, label)."""
    clean = set()
    for id_, vector, label, *_ in rows:
        if id_ is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = int(math.fmod(label + 1, 10)) if id_ % 7 == 0 else label
        clean.add((id_, label, tuple(math.floor(256 * float(x)) for x in vector)))
    out = []
    for a, la, va in clean:
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, v, strict=False)), i, label) for i, label, v in clean)
        for p, i, _ in [s for s in scored if s[2] == la and s[1] != a][:5]:
            window = [s for s in scored if s[2] != la and 80 * -p <= 100 * -s[0] <= 100 * -p][:5]
            out += [(a, i, k + 1, n, -p, -s) for k, (s, n, _) in enumerate(window)]
    return sorted(out)


def found(df, **options):
    return sorted(tuple(r) for r in hn.hard_negatives(df, **options).collect())


@pytest.mark.parametrize("shape", [(1, 1, 1), (5, 64, 7), (33, 65, 130), (200, 64, 301), (64, 0, 3), (70, 100, 90)])
@pytest.mark.parametrize("most", [300, 1 << 26])
def test_strassen_is_exact(shape, most):
    draw = np.random.default_rng(shape[0])
    a, b = draw.integers(-most, most, shape[:2]), draw.integers(-most, most, shape[1:])
    for leaf in (8, 32):
        assert (hn.strassen(a, b, leaf) == a @ b).all()


def test_strassen_refuses_what_does_not_fit():
    with pytest.raises(OverflowError):
        hn.strassen(np.full((2, 2), 1 << 40), np.full((2, 2), 1 << 40))


def test_heaps_merge_to_the_same(spark):
    draw = np.random.default_rng(3)
    slot, score, id_ = draw.integers(0, 9, 500), draw.integers(-4, 5, 500), np.arange(500)
    whole = hn.best(slot, score, id_, 5)
    parts = [hn.best(slot[i::3], score[i::3], id_[i::3], 5) for i in range(3)]
    assert all((x == y).all() for x, y in zip(hn.merged(parts, 5), whole, strict=True))


@pytest.mark.parametrize("mining", [hn.Mining(), hn.Mining(panel=2, panels=2, tile=37, strip=10, held=1)])
def test_equals_brute_force(spark, mining):
    draw = np.random.default_rng(8)
    rows = [(i, [float(x) for x in draw.normal(size=9).round(2)], int(i % 4)) for i in range(700)]
    rows += [(i + 700, rows[i][1], i % 3) for i in range(0, 300, 3)]  # ties
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").repartition(5)
    exact = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    assert found(df, mining=mining) == by_hand(exact) != []


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], 9), (100, [1.0, 2.0], 1), (100, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, [1.0, 1.9], 1), (3, [1.0, 2.0], 2), (3, [1.0, 2.0], 2),
        (4, [1.0, 2.0], None), (None, [1.0, 2.0], 1), (5, None, 1), (6, [1.0, None], 2), (8, [nan, 1.0], 2), (9, [inf, 1.0], 2), (10, [], 1), (11, [], 2),
        (12, [1.0], 1), (13, [1.0, 2.0, 3.0], 2), (14, [1.0, 2.0], 1), (-100, [0.5, 2.0], 1), (-7, [1.0, 2.0], -1), (200, [-1.0, -2.0], 2), (15, [1.0, 2.0], 2), (200, [3.0, 1.0], 5),
        (None, None, None),
    ]
    df = spark.createDataFrame([(*r, "x", "y", 3, None) for r in rows], SCHEMA).repartition(3)
    assert found(df) == by_hand(rows) != []
    assert found(df.where("vec_id % 100 <> 0")) == [] and found(df.limit(0)) == []


def test_one_label_and_equal_vectors(spark):
    """A third of the rows are copies of one vector; all scores tie."""
    rows = [(i, [0.5, 0.25], 1 if i % 3 else 2) for i in range(0, 900)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    assert found(df, mining=hn.Mining(tile=128, strip=50)) == by_hand(rows)


def test_too_large_is_an_error(spark):
    df = spark.createDataFrame([(100, [1e30], 1), (1, [1e30], 1)], "vec_id bigint, embedding array<float>, label int")
    with pytest.raises(Exception, match="64 bits"):
        found(df)
