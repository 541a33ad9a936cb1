"""The memory of spans against a dictionary, with few entries and with hashes that collide."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from feedplan.llm import span_memory
from feedplan.llm.words import Words


@pytest.mark.parametrize("most", [5, 200, 10_000])
@pytest.mark.parametrize("hashes", [None, 7])
def test_answers(monkeypatch, most, hashes):
    if hashes:  # only as many different hashes
        real = span_memory.span_hashes
        monkeypatch.setattr(span_memory, "span_hashes", lambda *a: real(*a) % np.uint64(hashes))
    asked = []

    def learn(spans):
        asked.extend(spans)
        return [(np.frombuffer(b"".join(x[::-1] for x in spans), np.uint8), np.array([len(x) for x in spans]))]

    memory = span_memory.SpanMemory(learn, [np.uint8], most)
    draw = np.random.default_rng(1)
    for _ in range(20):
        texts = [" ".join(str(int(x)) for x in draw.zipf(1.3, 40) % 3000) for _ in range(5)]
        words = Words.of(pa.array(texts))
        flat, sizes = memory.columns[0].take(memory.find(words.data, words.start, words.end))
        assert flat.tobytes() == "".join(w[::-1] for t in texts for w in t.split()).encode() and sizes.tolist() == [len(w) for t in texts for w in t.split()]
    if most > 3000 and not hashes:
        assert len(asked) == len(set(asked))


def test_nothing_to_find():
    memory = span_memory.SpanMemory(lambda spans: [], [], 10)
    none = np.zeros(0, np.int64)
    assert len(memory.find(np.zeros(0, np.uint8), none, none)) == 0
