"""Plan shapes that have to hold on large inputs."""

import re
from pathlib import Path

import pytest

from feedplan.functions import diagnostics as dx
from feedplan.operators.lookup import lookup
from feedplan.operators.matching import match_target
from feedplan.operators.vault import latest_secrets, vault_rows
from feedplan.plans import feeds, queries, sync
from feedplan.sources.pages import explode_records, pages_read, parse_pages, require_good_pages
from feedplan.sources.staging import shared_folder

ROOT = Path(__file__).resolve().parent.parent


@pytest.fixture
def small_limits(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def hot_feed(spark, n=200_000):
    """A third of the rows share one key, another third has none."""
    key = "case id % 3 when 0 then 'hot' when 1 then null else concat('k', id % 5000) end"
    return spark.range(0, n, 1, 16).selectExpr("id as line_no", f"{key} as match_key", "sha2(cast(id as string), 256) as pad")


def test_a_hot_key_is_split(spark, small_limits):
    target = spark.range(0, 30_000, 1, 8).selectExpr(
        "concat('i', id) as _id", "if(id % 3 = 0, 'hot', concat('k', id)) as match_key", "'a' as account_status",
        "cast(null as string) as deletion_date", "id as _ouid",
    )
    matched = match_target(hot_feed(spark), target, ("_id", "_ouid"))
    plan = final_plan(matched.selectExpr("sum(n_candidates)", "count(candidate)", "sum(length(pad))"))
    assert "SortMergeJoin(skew=true)" in plan
    counts = {r.match_status: r["count"] for r in matched.groupBy("match_status").count().collect()}
    hot = 200_000 // 3 + 1
    single = matched.where("match_key <> 'hot' and match_status = 'matched'").count()
    assert counts["conflict"] == hot and counts["matched"] == single > 0
    assert sum(counts.values()) == 200_000


def test_a_small_side_is_repeated_over_salts(spark, small_limits):
    keys = spark.createDataFrame([("hot", 1), ("k2", 2)], "k string, v int")
    joined = lookup(hot_feed(spark, 3000), keys, {"match_key": "k"}, "line_no", salts=8)
    assert joined.count() == 3000 and joined.where("v = 1").count() == 1000


def test_flow_has_no_cross_join_and_reads_only_needed_columns(spark):
    sf = "/root/testdata/sf0.001"
    raw, target = feeds.raw_feed(spark, sf), feeds.target(spark, sf)
    rows = sync.decided(raw, target, feeds.orgs(spark, sf))
    plan = final_plan(rows.select("line_no", "decision"))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", final_plan(sync.mapped(raw).select("line_no", "user_name")))
    assert schemas == ["c_custkey:bigint"]


def few_customers(spark, folder, n=400):
    """One row group; some keys are null, others come twice."""
    rows = spark.range(0, n, 1, 1).selectExpr("nullif(id div 2, 7) as c_custkey", "id % 25 as c_nationkey", "concat('S', id % 5) as c_mktsegment")
    rows.coalesce(1).write.parquet(f"{folder}/customer.parquet")


def test_rows_of_one_row_group_are_parsed_by_many_tasks(spark, tmp_path, monkeypatch):
    few_customers(spark, tmp_path)
    before = sorted(map(str, feeds.raw_feed(spark, str(tmp_path)).collect()))
    monkeypatch.setattr(feeds, "ROWS_A_TASK", 50)
    raw = feeds.raw_feed(spark, str(tmp_path))
    assert sorted(map(str, raw.collect())) == before
    parts = sync.normalized(raw).selectExpr("spark_partition_id() as part").groupBy("part").count().collect()
    assert len(parts) == 8 and max(r["count"] for r in parts) <= 60


def test_only_small_sides_pass_through_the_driver(spark):
    rows = spark.range(0, 200_000, 1, 4).selectExpr("id as line_no", "sha2(cast(id as string), 256) as k")
    for n, broadcast in ((500, True), (120_000, False)):
        right = rows.where(f"line_no < {n}").selectExpr("k", "sha2(k, 256) as v").distinct()  # 500 rows, and about 6 MB
        plan = final_plan(lookup(rows, right, {"k": "k"}, "line_no").selectExpr("count(v)", "max(v)"))
        assert ("BroadcastHashJoin" in plan) == broadcast, plan


def test_secrets_are_parsed_where_the_cells_are_dealt_out(spark, tmp_path, monkeypatch):
    few_customers(spark, tmp_path)
    monkeypatch.setattr(feeds, "ROWS_A_TASK", 50)
    raw = feeds.raw_feed(spark, str(tmp_path))
    rows = spark.range(400).selectExpr("'' as source_id", "id as line_no", "concat('k', id) as match_key", "map('password', '***') as secrets", f"{dx.NONE} as errors")
    plan = vault_rows(rows, sync.feed_secrets(raw), "d", "r", "2024", ())._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Repartition")
    assert "password" in above and "regexp_" not in below, plan


def test_both_parts_of_a_split_read_one_validation(spark):
    sf = "/root/testdata/sf0.001"
    split = queries.valid_split(spark, sf)
    plan = split._jdf.queryExecution().optimizedPlan().toString()
    assert "REQUIRED_FIELD_MISSING" not in plan and "Join" not in plan, plan
    rows = queries.validated(spark, sf).select("line_no", "errors").collect()
    assert sorted(map(tuple, split.collect())) == sorted((r.line_no, "blocked" if r.errors else "valid") for r in rows)


def test_library_keeps_off_the_driver():
    for path in (ROOT / "feedplan").rglob("*.py"):
        if path.parent.name == "llm":
            continue  # has its own bounds
        source = path.read_text()
        assert ".collect()" not in source and ".toPandas()" not in source, path
        assert "localCheckpoint" not in source and "crossJoin" not in source, path
        # a bare function given to transform would receive the element index
        assert not re.search(r"F\.(?:transform|filter)\([^,]+, F\.\w+\)", source), path


def test_matching_and_vault_aggregate_by_hash(spark, small_limits):
    sf = "/root/testdata/sf0.001"
    raw, target = feeds.raw_feed(spark, sf), feeds.target(spark, sf)
    rows = sync.normalized(raw).selectExpr("line_no", "user_name as match_key")
    stored = spark.range(50).selectExpr("'d' as dataset", "'f' as field", "concat('k', id % 7) as match_key", "concat('v', id) as value", "'r' as run_id", "id as seq")
    logged = stored.selectExpr("*", "seq % 3 as append")
    for df in (match_target(rows, target, ("_id", "_ouid")), latest_secrets(stored), latest_secrets(logged)):
        plan = final_plan(df)
        assert "HashAggregate" in plan and not re.search(r"SortAggregate\(key=\[match_key", plan)


def test_a_page_is_parsed_once(spark):
    dump = spark.createDataFrame([(1, '{"items":[{"_id":"a"}]}')], "page bigint, body string")
    records = explode_records(require_good_pages(pages_read(parse_pages(dump), 5)))
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    # once for the records, once for the last page of the sequence, whose subquery is printed twice
    assert 1 <= plan.count("parseJson(") <= 3, plan


def test_no_folder_of_one_machine_on_a_cluster(monkeypatch):
    class Context:
        master = "spark://somewhere:7077"

        def getConf(self):  # noqa: N802
            return {}

    class Session:
        conf = {}
        sparkContext = Context()  # noqa: N815

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session())
