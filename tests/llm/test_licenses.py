from __future__ import annotations

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from feedplan.llm import licenses

FILES = [
    (1, "p/LICENSE", "Released under the MIT License."),
    (2, "p/src/a.py", "code\n# Licensed under the Apache License, Version 2.0.\nmore"),
    (3, "p/src/deep/b.py", "no notice at all"),
    (4, "p/src/deep/COPYING", "This work is licensed under the GNU General Public License, version 3."),
    (5, "p/src/deep/er/c.py", None),
    (6, "q/d.py", "All rights reserved.\nThis work is licensed under the GNU General Public License, version 3."),
    (7, "q/e.py", ""),
    (8, None, "Released under the MIT License."),
    (9, None, "nothing"),
    (10, "top.py", "the license of a plate is a story that has no end and no template for it"),
    (3, "p/src/deep/b.py", "no notice at all"),
    (11, "p/srcfile/x", "x"),
]


@pytest.fixture(scope="module")
def found(spark):
    files = spark.createDataFrame(FILES, "doc_id bigint, path string, text string").withColumn("licence", F.lit("clash"))
    return licenses.scanned(files, licenses.templates(spark), "doc_id", F.col("path")).collect()


def test_headers_and_inheritance(found):
    rows = {r.doc_id: (r.licence, r.licence_from, r.inherited_from) for r in found}
    assert len(found) == len(FILES)
    assert rows == {
        1: ("MIT", "header", None), 2: ("Apache-2.0", "header", None), 3: ("GPL-3.0", "inherited", "p/src/deep/"),
        4: ("GPL-3.0", "header", None), 5: ("GPL-3.0", "inherited", "p/src/deep/"), 6: ("GPL-3.0", "header", None),
        7: ("GPL-3.0", "inherited", "q/"), 8: ("MIT", "header", None), 9: (None, "none", None), 10: (None, "none", None),
        11: ("MIT", "inherited", "p/"),
    }


def test_cosines_equal_brute_force(spark):
    notices = ["Released under the MIT License.", "licensed under version 3 and 4.0", "Copyright 2020 A\nAll rights reserved."]
    parts = {n: [n, *n.split("\n")] if "\n" in n else [n] for n in notices}
    terms = lambda t: Counter(re.findall(r"[a-z0-9]+(?:[.][0-9]+)*", t.lower()))
    texts = [*{p for x in parts.values() for p in x}, *(t for _, t in licenses.TEMPLATES)]
    seen = Counter(t for x in texts for t in terms(x))
    weigh = lambda t: {k: (math.log(n) + 1) * (math.log((len(texts) + 1) / (seen[k] + 1)) + 1) for k, n in terms(t).items()}

    def cosine(a, b):
        x, y = weigh(a), weigh(b)
        norm = math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))
        return round(sum(v * y.get(k, 0) for k, v in x.items()) / norm, 6)

    expected = {n: min((-cosine(p, t), name) for p in parts[n] for name, t in licenses.TEMPLATES) for n in notices}
    out = licenses.scored(spark.createDataFrame([(n,) for n in notices * 2], "text string"), licenses.templates(spark)).collect()
    assert {r.text: (pytest.approx(-r.cosine, abs=2e-6), r.licence) for r in out} == expected and len(out) == 3


def test_no_python_in_the_plan(spark, odd_docs):
    out = licenses.scanned(odd_docs, licenses.templates(spark), "doc_id", F.col("source"))
    assert not re.search("Python|Arrow|Pandas", out._jdf.queryExecution().toString())


def test_rows(spark, odd_docs, no_docs):
    known = licenses.templates(spark)
    out = licenses.scanned(odd_docs, known, "doc_id", F.col("source")).collect()
    assert len(out) == odd_docs.count() and {r.licence_from for r in out} == {"none"}
    assert licenses.scanned(no_docs, known, "doc_id", F.col("source")).count() == 0
