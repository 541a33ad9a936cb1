from __future__ import annotations

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, `n` string, `key` string, `words` string, `score` string, `leaks` string"


def row(doc_id, text, lang="en", source="s"):
    return (doc_id, text, lang, source, None if text is None else len(text), None, "k", None, "x", "y")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls everywhere, empty and blank texts, a long one, repeated rows, and columns that clash with inner names."""
    long_text = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    rows = [
        row(1, None), row(2, ""), row(3, " \n\t "), row(4, "one"), row(5, "one"), row(6, long_text), row(None, "no id here at all but words"),
        row(7, "the same words in a row that repeats itself", None, None), row(7, "the same words in a row that repeats itself", None, None),
        row(8, "\x00   é 日本 😀 \x85 end"), row(9, "x" * 5_000),
        (None, None, None, None, None, None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
