"""Every query with a SQL twin gives the same rows in DuckDB."""

import duckdb
import pytest

from feedplan.plans import oracle, queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
STATEMENTS = oracle.all_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_a_twin():
    assert set(queries.all_queries()) == set(STATEMENTS)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shown = [tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order) for r in rows]
    return [columns[i] for i in order], sorted(shown, key=str)


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_same_rows(spark, duck, name):
    result = queries.all_queries()[name](spark, SF)
    cursor = duck.execute(STATEMENTS[name])
    expected = table([c[0] for c in cursor.description], cursor.fetchall())
    assert table(result.columns, [tuple(r) for r in result.collect()]) == expected

