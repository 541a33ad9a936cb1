from __future__ import annotations

import math
import zlib

import numpy as np
import pytest

from feedplan.llm.langid import BLOCK, LETTERS, PAD, Network, Training, _block, held_out, languages, sample, windows

SF = "/root/testdata/sf0.01"


def test_gradients_equal_differences():
    net = Network(["a", "b", "c"], 4, 1)
    net.parts = [p.astype(np.float64) for p in net.parts]
    draw = np.random.default_rng(0)
    rows, label = draw.integers(97, 123, (5, 12)).astype(np.int32), np.array([0, 1, 2, 0, 1])
    _, grads = net.gradients(rows, label)
    for part, grad in zip(net.parts, grads, strict=True):
        at = np.unravel_index(np.argmax(np.abs(grad)), grad.shape)
        part[at] += 1e-3
        up, _ = net.gradients(rows, label)
        part[at] -= 2e-3
        down, _ = net.gradients(rows, label)
        part[at] += 1e-3
        assert grad[at] == pytest.approx((up - down) / 2e-3, rel=0.01, abs=1e-4)


def test_probabilities_cover_every_letter():
    net = Network(["a", "b"], 4, 1)
    rows = np.array([[*b"abc de", 256, 256]], np.int32)
    total = net.probabilities(rows)
    assert total[0, -1] == 5 and total[0, :-1].sum() == pytest.approx(5, rel=1e-5)
    assert LETTERS[256] == 0


def by_hand(net, row):
    """Forward pass of one window, number by number."""
    units = len(net.parts[4]) // 2
    clip = lambda x, low: max(low, min(1.0, x))

    def states(x, u, seen):
        h, out = [0.0] * units, []
        for b in seen:
            g = [sum(h[k] * float(u[k, j]) for k in range(units)) for j in range(3 * units)]
            a = [float(v) for v in x[b]]
            new = []
            for j in range(units):
                z, r = clip(a[j] + g[j], 0.0), clip(a[units + j] + g[units + j], 0.0)
                n = clip(a[2 * units + j] + r * g[2 * units + j], -1.0)
                new.append(n + z * (h[j] - n))
            h = new
            out.append(h)
        return out

    ahead, behind = states(net.parts[0], net.parts[1], row), states(net.parts[2], net.parts[3], row[::-1])[::-1]
    total = [0.0] * (len(net.labels) + 1)
    for b, f, k in zip(row, ahead, behind, strict=True):
        if b == PAD or not (b >= 128 or chr(b).isalpha()):
            continue
        logits = [sum(s * float(v) for s, v in zip(f + k, net.parts[4][:, c], strict=True)) + float(net.parts[5][c]) for c in range(len(net.labels))]
        e = [math.exp(x - max(logits)) for x in logits]
        for c, x in enumerate(e):
            total[c] += x / sum(e)
        total[-1] += 1
    return total


def test_forward_pass_by_hand():
    net = Network(["a", "b", "c"], 8, 2)
    draw = np.random.default_rng(1)
    rows = draw.integers(0, 257, (20, 64)).astype(np.int32)
    rows[:10] = np.where(draw.random((10, 64)) < 0.8, draw.integers(97, 123, (10, 64)), 32)
    got = net.probabilities(rows)
    for row, total in zip(rows, got, strict=True):
        assert total == pytest.approx(by_hand(net, row.tolist()), rel=1e-3, abs=1e-3)


def test_a_window_has_one_result_at_any_place():
    net = Network(["a", "b", "c"], 8, 2)
    draw = np.random.default_rng(2)
    row = draw.integers(97, 123, (1, 64)).astype(np.int32)
    seen = set()
    for place in [*range(0, 40), 511, BLOCK - 2, BLOCK - 1]:
        others = draw.integers(0, 257, (draw.integers(place, BLOCK), 64)).astype(np.int32)
        block = _block(np.concatenate([others[:place], row, others[place:]]))
        assert block.shape == (BLOCK, 64)
        seen.add(net.probabilities(block)[place].tobytes())
    assert len(seen) == 1


def test_equal_texts_have_equal_scores(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").where("lang is not null").limit(60).collect()]
    docs = [(i, texts[i % 60] if i % 2 else texts[(i * 7) % 60][: 10 + i], "en" if i % 3 else "de") for i in range(600)]
    found = languages(spark.createDataFrame(docs, "doc_id bigint, text string, lang string").repartition(5), how=Training(steps=30)).collect()
    by_text = {}
    for r in found:
        by_text.setdefault(docs[r.doc_id][1], set()).add((r.lang_pred, r.score))
    assert len(found) == 600 and all(len(x) == 1 for x in by_text.values())


def test_windows_hold_all_bytes():
    data = np.frombuffer(b"aaabbbbbc", np.uint8)
    rows, text = windows(data, np.array([0, 3, 3, 8, 9]), 4)
    assert text.tolist() == [0, 2, 2, 3]
    assert rows.tolist() == [[97, 97, 97, 256], [98] * 4, [98, 256, 256, 256], [99, 256, 256, 256]]


def test_sample_of_a_label_with_many_copies(spark):
    texts = ["the same text again"] * 1800 + [f"text number {i}" for i in range(200)]
    docs = spark.createDataFrame([("en", t) for t in texts], "lang string, text string")
    parts, labels = sample(docs, "lang", "text", Training(per_language=100))
    assert 70 <= len(parts) == len(set(parts)) <= 130 and set(labels) == {"en"}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    apart = [r for r in found if r.held_out]
    assert sum(r.lang_pred == r.lang for r in apart) >= 0.97 * len(apart)
    assert all(0 <= r.score <= 1 for r in found)


def test_rows(spark, odd_docs, no_docs):
    quick = Training(steps=30)
    rows = {r.doc_id: r for r in languages(odd_docs, how=quick).collect()}
    assert rows[1].lang_pred == rows[2].lang_pred == rows[3].lang_pred == "und" and rows[1].score == 0
    assert rows[6].lang_pred == "en"
    assert languages(no_docs, how=quick).count() == 0
    blank = spark.createDataFrame([(1, "text", None), (2, None, None)], "doc_id bigint, text string, lang string")
    assert {r.lang_pred for r in languages(blank).collect()} == {"und"}


def test_ids_and_labels_are_no_inputs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300)
    quick = Training(steps=30, per_language=50)
    held = docs.where(held_out("doc_id"))
    changed = docs.where(~held_out("doc_id")).unionByName(held.selectExpr("doc_id", "text", "'xx' as lang", "'y' as source", "0L as n_chars"))
    a = {r.doc_id: r.lang_pred for r in languages(docs, how=quick).collect()}
    assert a == {r.doc_id: r.lang_pred for r in languages(changed, how=quick).collect()}
