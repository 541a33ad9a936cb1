from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from feedplan.llm.repetition import Limits, longest_repeats, measure, verdicts


def by_hand(text, limits):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    n, seen, dup = len(w), set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    runs = Counter(tuple(w[i : i + 3]) for i in range(n - 2))
    repeated = {i + j for i in range(n - 2) if runs[tuple(w[i : i + 3])] > 1 for j in range(3)}
    best = [0] * n
    for i in range(n):
        for j in range(n):
            k = 0
            while i != j and i + k < n and j + k < n and w[i + k] == w[j + k]:
                k += 1
            best[i] = max(best[i], k)
    cover = {j for i in range(n) if best[i] >= limits.shortest for j in range(i, i + best[i])}
    failed = n < 50 or 100 * len(repeated) > 50 * n
    too_much = len(cover) > limits.covered * n or max(best, default=0) > limits.longest
    return {
        "n_words": n, "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_dup_lines": dup,
        "n_repeat_words": len(repeated), "base_failed": failed, "n_covered": len(cover), "longest_repeat": max(best, default=0),
        "kept": not failed and not too_much,
    }


def test_equals_brute_force():
    draw = random.Random(1)
    limits = Limits(shortest=4, covered=0.2, longest=9)
    texts = [None, "", " ", "a", "\n\n", "a\na\n a\na"]
    texts += ["".join(draw.choice(["a ", "b ", "ä| ", "\n", "c# "]) for _ in range(draw.randint(0, 150))) for _ in range(120)]
    texts += [" ".join(f"v{draw.randint(0, 60)}" for _ in range(120)) for _ in range(40)]
    found = measure(pa.array(texts), limits)
    for i, text in enumerate(texts):
        assert {k: v[i] for k, v in found.items()} == by_hand(text, limits)


def test_verdict_of_the_method():
    base = [f"w{i}" for i in range(200)]
    clean, copied = " ".join(base), " ".join(base[:100] + base[:100])
    sparse = " ".join(base + base[:45])  # repeats, but under a fifth of the words
    found = measure(pa.array([clean, copied, sparse]), Limits(covered=0.3, longest=40))
    assert found["kept"].tolist() == [True, False, False]
    assert found["longest_repeat"].tolist() == [0, 100, 45]


def test_one_word_many_times():
    assert longest_repeats(np.zeros(1000, np.int64), np.zeros(1000, np.int64)).tolist() == [999, *range(999, 0, -1)]


def test_rows(odd_docs, no_docs):
    rows = {(r.doc_id, r.n_words): r for r in verdicts(odd_docs).collect()}
    assert verdicts(odd_docs).count() == odd_docs.count()
    assert rows[6, 30_000].kept and rows[6, 30_000].n_covered == 0
    assert not rows[1, 0].kept and rows[1, 0].base_failed
    assert verdicts(no_docs).count() == 0
