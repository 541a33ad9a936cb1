"""Codes by permutation, bounded samples and last records: against plain Python, and their plans."""

import random
import re

import pytest
from pyspark.sql import functions as F

from feedplan.functions import diagnostics as dx
from feedplan.operators import report
from feedplan.operators.codes import numbered, permuted, permuted_codes, round_keys, width_for
from feedplan.operators.enrich import allocate_codes, enrich, picked_code, sized
from feedplan.operators.snapshot import last_records
from feedplan.plans import employees
from feedplan.sources.staging import staged
from helpers import users


@pytest.mark.parametrize("width", [1, 2, 3, 4])
def test_a_permutation_and_its_inverse(spark, width):
    n = 16**width
    rows = spark.range(n).select("id", permuted(F.col("id"), width, "s").alias("x"), permuted(F.col("id"), width, "t").alias("y"))
    rows = rows.withColumn("back", permuted(F.col("x"), width, "s", backwards=True)).collect()
    assert {r.x for r in rows} == set(range(n)) and all(r.back == r.id for r in rows)
    assert width == 1 or sum(r.x == r.y for r in rows) < n / 4


def test_wide_ordinals_stay_inside_64_bits(spark):
    top = 16**15 - 1
    draw = random.Random(1)
    values = [0, 1, top, *(draw.randrange(top) for _ in range(500))]
    rows = spark.createDataFrame([(v,) for v in values], "v bigint").withColumn("x", permuted(F.col("v"), 15, "s"))
    rows = rows.withColumn("back", permuted(F.col("x"), 15, "s", backwards=True)).collect()
    assert all(0 <= r.x <= top and r.back == r.v for r in rows)

    def by_hand(v):
        left, right = v >> 30, v & (2**30 - 1)
        for factor, summand in round_keys("s"):
            left, right = right, left ^ (((right + summand) * factor) >> 16) & (2**30 - 1)
        return (left << 30) + right

    assert all(by_hand(r.v) == r.x for r in rows)
    with pytest.raises(ValueError, match="1 to 15 digits"):
        permuted(F.col("v"), 16, "s")


def test_rows_are_numbered_in_order(spark):
    rows = spark.range(1000).selectExpr("concat('f', id % 7) as source_id", "id as line_no").repartition(5)
    got = {(r.source_id, r.line_no): r["__rank"] for r in numbered(rows, ["source_id", "line_no"], "t").collect()}
    assert got == {k: i for i, k in enumerate(sorted(got))} and len(got) == 1000
    assert numbered(rows.limit(0), ["source_id", "line_no"], "t").count() == 0


def order(width, seed):
    """All codes of a width, as the permutation orders them."""
    half, out = 2 * width, []
    for v in range(16**width):
        left, right = v >> half, v & (2**half - 1)
        for factor, summand in round_keys(seed):
            left, right = right, left ^ (((right + summand) * factor) >> 16) & (2**half - 1)
        out.append((left << half) + right)
    return out


@pytest.mark.parametrize(("n", "n_held", "seed"), [(40, 30, 1), (200, 90, 2), (300, 0, 3), (0, 10, 4), (7, 256, 5)])
def test_codes_equal_a_sequential_allocation(spark, n, n_held, seed):
    draw = random.Random(seed)
    need = [(f"f{draw.randint(0, 2)}", i, draw.choice([None, f"k{draw.randint(0, n)}"])) for i in range(n)]
    held = [(f"T-{x:02x}", draw.choice([None, *[f"k{draw.randint(0, n)}"] * 3])) for x in draw.sample(range(256), n_held)]
    held += held[:3] + [("T-abc", "k1"), ("t-01", "k1"), ("T-0G", "k1"), (None, "k2"), ("T-01\n", "k1")] + [(c, "other") for c, _ in held[5:8]]
    got = permuted_codes(
        spark.createDataFrame(need, "source_id string, line_no bigint, match_key string").repartition(3),
        spark.createDataFrame(held, "code string, match_key string"), "code", "match_key", "T-", 2, "s", ["source_id", "line_no"],
    )
    holders, own = {}, {}
    for code, who in held:
        if code and re.fullmatch(r"T-[0-9a-f]{2}", code):
            holders.setdefault(int(code[2:], 16), set()).update({who} - {None})
    for x in sorted(holders, reverse=True):
        if len(holders[x]) == 1:
            own[min(holders[x])] = x
    expected, given = {}, set()
    free = iter([x for x in order(2, "s") if x not in holders])
    for source, line, who in sorted(need, key=lambda r: r[:2]):
        if who in own and who not in given:
            given.add(who)
            expected[source, line] = own[who] + 1
        else:
            expected[source, line] = next(free, -1) + 1
    rows = [((r.source_id, r.line_no), r.pick) for r in got.collect()]
    assert dict(rows) == expected and len(rows) == n
    picks = [p for _, p in rows if p]
    assert len(set(picks)) == len(picks)
    # every row is served while a code is free
    assert sum(p == 0 for _, p in rows) == max(0, n - len(given) - (256 - len(holders)))


def test_a_repeated_run_gives_the_same_codes(spark):
    spec = employees.enrich_spec("run", code_width=2, code_draws="permutation")
    rows = spark.range(2, 102).selectExpr("id as line_no", "concat('k', id) as match_key", "cast(null as string) as usr_org_tab_num", f"{dx.NONE} as errors")
    first = staged(allocate_codes(rows, users(spark), spec).selectExpr("line_no", f"{picked_code(spec)} as usr_org_tab_num"), "first")
    written = users(spark).unionByName(first.selectExpr("concat('i', line_no) as _id", "concat('k', line_no) as match_key", "usr_org_tab_num"), allowMissingColumns=True)
    # what the target holds is kept, and half of the rows are new
    again = allocate_codes(rows.unionByName(rows.withColumn("line_no", F.col("line_no") + 100).withColumn("match_key", F.concat(F.lit("n"), "line_no"))), written, spec)
    now = {r.line_no: r.code for r in again.selectExpr("line_no", f"{picked_code(spec)} as code").collect()}
    before = {r.line_no: r.usr_org_tab_num for r in first.collect()}
    assert len(set(before.values())) == 100 and {k: now[k] for k in before} == before
    assert len(set(now.values())) == 200 and all(re.fullmatch(r"TAB-[0-9a-f]{2}", c) for c in now.values())


def test_permuted_codes_in_the_enrichment(spark):
    spec = employees.enrich_spec("run", code_draws="permutation")
    rows = staged(
        spark.range(2, 60).selectExpr(
            "id as line_no", "cast(id as string) as personnel_number", "'L' as last_name", "'F' as first_name", "'M' as middle_name",
            "if(id = 5, 'MINE', null) as usr_org_tab_num", "cast(null as string) as manager_key", "cast(map() as map<string,string>) as secrets", f"{dx.NONE} as errors",
        ), "rows",
    )
    done = enrich(rows, users(spark), spec).select("line_no", "usr_org_tab_num", "code_generated").collect()
    assert [r.usr_org_tab_num for r in done if not r.code_generated] == ["MINE"]
    drawn = {r.usr_org_tab_num for r in done if r.code_generated}
    assert len(drawn) == 57 and all(re.fullmatch(r"TAB-[0-9a-f]{8}", c) for c in drawn)
    assert [width_for(n, 8) for n in (0, 10**6, 10**9)] == [8, 8, 9] and sized(spec, rows).code_width == 8


def test_samples_equal_sorting(spark):
    draw = random.Random(4)
    stages, names = ["MAP", "VALIDATE"], ["A", "B", "C", None]
    rows = []
    for i in range(4000):
        kinds = [(stages[0], "HOT")] * (i % 3 == 0) + [(draw.choice(stages), draw.choice(names)) for _ in range(draw.choice([0, 0, 1, 3]))]
        rows.append((f"f{i % 4}", i // 4, "FAILED" if kinds else "OK", [(s, c, None, "m") for s, c in kinds]))
    df = spark.createDataFrame(rows, "source_id string, line_no bigint, status string, errors array<struct<stage:string,code:string,field:string,message:string>>").repartition(7)
    expected = {}
    for source, line, _, errors in sorted(rows, key=lambda r: r[:2]):
        for kind in {(s, c) for s, c, *_ in errors}:
            expected.setdefault(kind, []).append((source, line))
    found = report.diagnostic_samples(df, 10)
    got = {}
    for r in found.orderBy("place").collect():
        assert r.n_rows == len(expected[r.stage, r.code]) and r.truncated == (r.n_rows > 10)
        got.setdefault((r.stage, r.code), []).append((r.source_id, r.line_no))
    assert got == {k: v[:10] for k, v in expected.items()}
    assert report.diagnostic_samples(df.limit(0), 10).count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    # tasks, parts and groups each keep their first rows
    assert len(re.findall(r"WindowGroupLimit .*Partial", plan)) >= 2, plan
    for limit in (0, 1001):
        with pytest.raises(ValueError, match="1 to 1000"):
            report.diagnostic_samples(df, limit)


def test_last_records_do_not_aggregate_whole_records(spark):
    kinds = ["inserted", "updated", "failed", "skipped"]
    draw = random.Random(6)
    rows = [(i, f"k{draw.randint(0, 150)}", draw.choice(kinds), f"v{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "ingest_pos bigint, _id string, outcome string, v string").repartition(4)
    expected = {key: v for _, key, kind, v in rows if kind in kinds[:2]}
    found = last_records(df, ["v", "_id"])
    got = [(r["_id"], r.v) for r in found.collect()]
    assert found.columns == ["v", "_id"] and dict(got) == expected and len(got) == len(expected)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "max_by" not in plan
