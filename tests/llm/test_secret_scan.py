from __future__ import annotations

import time
import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from feedplan.llm import secret_scan
from feedplan.llm.secret_scan import ALLOWED, KINDS, Windows, redacted, span_digests, with_spans
from tests.llm.conftest import documents

ASSIGN = r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def known(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, text) if len(m[1]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def threshold(c, w):
    if re.fullmatch("[0-9a-fA-F]+", c) and re.search("[0-9]", c) and re.search("[a-fA-F]", c):
        return w.hexadecimal
    if len(re.findall("[0-9]", c)) < 3 or not re.search("[a-z]", c):
        return math.inf
    return w.mixed if re.search("[A-Z]", c) else w.lower


def by_entropy(text, taken):
    w = Windows()
    for m in re.finditer("[A-Za-z0-9+/_=-]{20,}", text):
        c = m[0]
        if not re.search("[0-9]", c) or any(re.search(p, c) for p in ALLOWED):
            continue
        windows = [c[i : i + w.size] for i in range(len(c) - w.size + 1)]
        bits = [-sum(x.count(k) / w.size * math.log2(x.count(k) / w.size) for k in set(x)) for x in windows]
        high = [i for i, b in enumerate(bits) if b >= threshold(c, w) - 1e-12]
        if high:
            s, e = m.start() + high[0], m.start() + high[-1] + w.size
            if not any(a < e and s < b for a, _, b in taken):
                yield s, 3, e


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(2)
    alnum = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    rnd = lambda letters, n: "".join(draw.choice(letters) for _ in range(n))
    make = [
        lambda: "été", lambda: rnd(alnum, 30), lambda: rnd(alnum[:36], draw.randint(18, 45)), lambda: rnd(alnum[:16], draw.randint(18, 50)),
        lambda: "AKIA" + rnd(alnum[:10] + alnum[36:], draw.randint(10, 22)), lambda: "123e4567-e89b-12d3-a456-426614174000",
        lambda: draw.choice(["password", "API_KEY", "apikey", 'secret"', "Token"]) + draw.choice(["=", ": ", ' = "', ":'", ":"]) + rnd(alnum + ".=-", draw.randint(3, 12)),
        lambda: "src/main/java/example123", lambda: rnd("ab1", 30), lambda: "the",
    ]
    out = [None, "", 'é password="é" Passwd : abcdef tokEN=ab secret:token:abcdefg token=token=abcdef', "AKIAAKIA" + "A1" * 10 + " é AKIA12 AKIA"]
    for _ in range(600):
        out.append(draw.choice([" ", "\n", " é "]).join(draw.choice(make)() for _ in range(draw.randint(0, 25))))
    return out


def test_equals_brute_force(spark, texts):
    rows = with_spans(documents(spark, texts)).collect()
    digests = {r.doc_id: r for r in span_digests(documents(spark, texts)).collect()}
    for r in rows:
        base = known(r.text or "")
        spans = sorted(base + list(by_entropy(r.text or "", base)))
        assert [(s.start, s.kind, s.end) for s in r.secrets] == spans
        show = lambda x: ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in x)
        d = digests[r.doc_id]
        assert d.spans == show(spans) and d.base_sha256 == hashlib.sha256(show(base).encode()).hexdigest()
        assert (d.n_assign, d.n_access, d.n_hex) == tuple(sum(k == i for _, k, _ in base) for i in range(3))


def test_redaction(spark, texts):
    for r in redacted(with_spans(documents(spark, texts)).withColumn("before", F.col("text"))).collect():
        if r.before is None:
            assert r.text is None
            continue
        out, at = "", 0
        for s in r.secrets:
            if s.start >= at:
                out += r.before[at : s.start] + "[SECRET]"
            at = max(at, s.end)
        assert r.text == out + r.before[at:]


def test_no_python_in_the_plan(spark, odd_docs):
    plan = redacted(odd_docs)._jdf.queryExecution().toString() + span_digests(odd_docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_rows(odd_docs, no_docs):
    out = redacted(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()
    assert sorted(map(str, out.collect())) == sorted(map(str, odd_docs.collect()))
    assert span_digests(no_docs).count() == 0 and redacted(no_docs).count() == 0
    assert secret_scan.KINDS[3] == "entropy"


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 1500])
def test_many_matches(spark, n):
    """Places are added up in chunks; texts have more matches than one chunk holds."""
    draw = random.Random(n)
    words = [draw.choice(["é", "AKIA" + "Z9" * 9, "".join(draw.choices("0123456789abcdef", k=30)), "token=abc123", "x😀y"]) for _ in range(n)]
    text = " ".join(words)
    row = secret_scan.span_digests(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    base = known(text)
    assert row.spans == ",".join(f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in sorted(base + list(by_entropy(text, base))))


def test_long_strings_take_time_in_proportion(spark):
    draw = random.Random(5)
    took = []
    for size in (20_000, 80_000):
        text = "".join(draw.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=size))
        many = " ".join("".join(draw.choices("0123456789abcdef", k=32)) for _ in range(size // 20))
        begin = time.time()
        rows = secret_scan.span_digests(spark.createDataFrame([(1, text), (2, many)], "doc_id bigint, text string")).collect()
        took.append(time.time() - begin)
        assert {r.doc_id: r.n_hex for r in rows}[2] == size // 20 and {r.doc_id: r.spans for r in rows}[1].startswith("entropy:")
    assert took[1] < 10 * took[0] + 2
