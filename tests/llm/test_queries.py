"""The registered queries: SQL twins, and the pipeline against brute force."""

from __future__ import annotations

import re

import corpus_pipeline
import duckdb
import public_tokenizers
import pytest

from feedplan.llm import queries
from tests.llm.test_bpe import library  # noqa: F401
from tests.llm.test_chosen_path import by_hand as groups_by_hand
from tests.llm.test_decontaminate import by_hand as leaks_by_hand
from tests.llm.test_secret_scan import by_entropy, known

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(r[i] for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_rows(spark, duck, name):
    result = queries.queries()[name](spark, SF)
    cursor = duck.execute(queries.oracle_sql()[name])
    expected = table([c[0] for c in cursor.description], cursor.fetchall())
    assert table(result.columns, [tuple(r) for r in result.collect()]) == expected


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in queries.queries()) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - {"op5_jaccard_join", "op10_decontaminate", "op12_packing", "op13_hard_negatives"}))
def test_one_row_for_each_document(spark, name):
    result = queries.queries()[name](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert sorted(r.doc_id for r in result.select("doc_id").collect()) == sorted(r.doc_id for r in docs.select("doc_id").collect())


def test_pipeline_equals_brute_force(spark, library):  # noqa: F811
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sure = corpus_pipeline.language(spark, docs, SF)
    assert sure.columns == docs.columns and sure.count() >= 0.97 * docs.count()
    rows = [(r.doc_id, r.text) for r in sure.collect()]
    stay = [r for r, (least, _) in zip(rows, groups_by_hand(rows), strict=True) if r[0] == least]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {d for d, *_ in leaks_by_hand(stay, items)}
    expected = {}
    for id_, text in stay:
        if id_ in leaked:
            continue
        base = known(text or "")
        out, at = "", 0
        for s, _, e in sorted(base + list(by_entropy(text or "", base))):
            if s >= at:
                out += text[at:s] + "[SECRET]"
            at = max(at, e)
        expected[id_] = library.encode_ordinary(out + (text or "")[at:])
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: r.ids for r in got} == expected and len(got) == len(expected)
    assert all(r.n_tokens == len(r.ids) for r in got)
    assert public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_stages_keep_columns_and_survive_odd_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        now = docs
        for _, stage in corpus_pipeline.STAGES[1:-1]:
            now = stage(spark, now, SF)
            assert now.columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, now, SF).count() == now.count()
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    names = [r.doc_id for r in corpus_pipeline.near_duplicates(spark, odd_docs, SF).collect()]
    assert sorted(n for n in names if n) == [1, 2, 3, 4, 6, 7, 8, 9] and len([n for n in names if n is None]) == 2
