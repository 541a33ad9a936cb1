"""Vault, requests, outcomes, masking and artefacts."""

import json
import random
import time
from pathlib import Path

import pytest
from helpers import feed, orgs, users

from feedplan.functions import masking
from feedplan.operators import apply, vault
from feedplan.plans import employees, sync
from feedplan.sources import artifacts, staging
from feedplan.sources.staging import new_folder, staged


@pytest.fixture(scope="module")
def plan(spark):
    raw = feed(spark, {}, {"full_name": "New P X", "raw_id": "7", "extra": "org_id=20;tab=T7"}, {"login": "other", "extra": "password=p3;org_id=20;tab=TAB-4711"})
    return sync.plan_import(raw, users(spark, {"user_name": "old"}), orgs(spark, 20))


def entries(spark, *rows):
    return spark.createDataFrame([("d", "password", *r) for r in rows], vault.VAULT)


def test_latest_secret_and_run(spark):
    table = entries(spark, ("k", "v1", "r1", "t1", 0, 1), ("k", "v2", "r1", "t1", 0, 2), ("k", "v3", "r2", "t2", 1, 1))
    assert vault.latest_secrets(table).first().value == "v3"
    assert vault.latest_secrets(table, "r1").first().value == "v1"
    assert vault.latest_secrets(table, "r9").first().value == "v3"


def test_a_tie_in_time_goes_to_the_later_append(spark):
    table = entries(spark, ("k", "first", "r1", "t", 0, 900), ("k", "second", "r2", "t", 1, 2))
    assert vault.latest_secrets(table).first().value == "second"


def files_below(folder):
    return [p for p in Path(folder.removeprefix("file:")).rglob("*") if p.is_file()]


def test_the_flow_stores_secrets_and_stages_none(spark, tmp_path, monkeypatch):
    raw = feed(spark, {"extra": "password=streng1geheim;org_id=20;tab=T1"}, {"raw_id": "8", "extra": "org_id=20;tab=T2"}, {"raw_id": None})
    folder, path = str(tmp_path / "staged"), str(tmp_path / "vault")
    monkeypatch.setattr(staging, "shared_folder", lambda _: folder)
    done = sync.plan_import(raw, users(spark), orgs(spark, 20), employees.enrich_spec("r1"), vault=path)
    again = sync.plan_import(raw, users(spark), orgs(spark, 20), employees.enrich_spec("r2"), vault=path)
    kept = vault.read_vault(spark, path)
    applied = sync.apply_plan(done.items, users(spark), kept)
    assert {r.line_no: r.outcome for r in applied.outcome.collect()} == {2: "created", 3: "created"}
    assert applied.table.count() == 2 and again.summary.first().planned_create == 2
    assert [r.status for r in applied.report.collect()] == ["OK", "OK"]
    rows = {(r.match_key, r.run_id): r for r in kept.collect()}
    assert rows["Quint|Mara|Ilse|4711", "r1"].value == "streng1geheim" and len(rows["Quint|Mara|Ilse|8", "r1"].value) == 32
    assert len(rows) == 4 and (rows["Quint|Mara|Ilse|4711", "r2"].append, rows["Quint|Mara|Ilse|4711", "r2"].seq) == (1, 2)
    assert vault.latest_secrets(kept).count() == 2
    staged_files = files_below(folder)
    values = [r.value.encode() for r in rows.values()]
    assert staged_files and not any(v in p.read_bytes() for p in staged_files for v in values)
    for path in {str(p.parent) for p in staged_files if p.suffix == ".parquet"}:
        text = str(spark.read.parquet(path).collect())
        assert "streng1geheim" not in text


def test_a_batch_is_stored_once(spark, tmp_path):
    """The second time nothing is drawn, and the value of the first time is found."""
    raw = feed(spark, {"extra": "password=streng1geheim;org_id=20;tab=T1"}, {"raw_id": "8", "extra": "org_id=20;tab=T2"})
    path = str(tmp_path / "vault")
    rows = sync.enriched(raw, users(spark))
    found = []
    for batch in ("1", "1", "2", "1"):
        assert [r.errors for r in sync.stored(rows, raw, path, employees.enrich_spec("r"), batch=batch).collect()] == [[], []]
        found.append({(r.match_key, r.append): r.value for r in vault.read_vault(spark, path).collect()})
    assert found[0] == found[1] and len(found[0]) == 2 and found[2] == found[3] and len(found[2]) == 4
    assert found[0].items() < found[2].items()
    assert found[2]["Quint|Mara|Ilse|8", 0] != found[2]["Quint|Mara|Ilse|8", 1]
    # another run is another batch; what was written but not published does not count
    spark.createDataFrame([("d", "password", "k", "lost", "r", "t", 9, 9)], vault.VAULT).write.parquet(f"{path}/data/torn")
    sync.stored(rows, raw, path, employees.enrich_spec("s"), batch="1")
    assert vault.read_vault(spark, path).count() == 6


def test_two_publications_of_one_batch(spark, tmp_path):
    """As when a writer that was taken for lost comes back: the first one counts."""
    path = str(tmp_path / "vault")
    for n, folder in enumerate(("a", "b")):
        spark.createDataFrame([("d", "password", "k", f"v{n}", "r", "t", 0, 1)], vault.VAULT).write.parquet(f"{path}/data/{folder}")
        entry = spark.createDataFrame([("d", "r", "1", 0, folder)], "dataset string, run_id string, batch string, append bigint, folder string")
        entry.selectExpr("*", f"timestamp'2024-01-01' + make_interval(0, 0, 0, {n}) as committed_at").write.mode("append").parquet(f"{path}/appends")
    assert [r.value for r in vault.read_vault(spark, path).collect()] == ["v0"]


def test_sources_with_one_line_number_do_not_tie(spark, tmp_path):
    raw = feed(spark, {"extra": "password=zz;org_id=20;tab=T1"}, {"extra": "password=aa;org_id=20;tab=T1"})
    raw = raw.selectExpr("if(line_no = 2, 'a', 'b') as source_id", "2L as line_no", *raw.columns[1:])
    path = str(tmp_path / "vault")
    sync.stored(sync.enriched(raw, users(spark, {})), raw, path, employees.enrich_spec("r"))
    kept = vault.read_vault(spark, path)
    assert sorted(r.seq for r in kept.collect()) == [2, (1 << 40) + 2]
    assert [r.value for r in vault.latest_secrets(kept).collect()] == ["aa"]  # of the last source, not the larger text


def test_a_vault_that_cannot_be_written_stops_its_rows(spark, tmp_path):
    (tmp_path / "vault").write_text("a file, not a folder")
    raw = feed(spark, {})
    rows = sync.stored(sync.enriched(raw, users(spark)), raw, str(tmp_path / "vault" / "below"), employees.enrich_spec())
    assert [[e.code for e in r.errors] for r in rows.collect()] == [["SECRET_STORE_ERROR"]]


def test_generated_secrets_differ(spark):
    raw = feed(spark, *[{"raw_id": str(i), "extra": "org_id=20;tab=T"} for i in range(40)])
    drawn = vault.vault_rows(sync.enriched(raw, users(spark)), sync.feed_secrets(raw), "employees", "r", "t").collect()
    assert len({r.value for r in drawn}) == len(drawn) == 40 and all(r.generated and len(r.value) == 32 for r in drawn)


def test_keyed_fallback(spark):
    asked = spark.createDataFrame([(1, "d", "f", "a", 1), (2, "d", "f", "a", 2), (3, "d", "f", "b", 3), (4, "d", "f", "b", 4), (5, "d", "g", "b", 4)],
                                  "request_no bigint, dataset string, field string, row_id string, line_no bigint")
    table = spark.createDataFrame([("d", "f", "a", 1, "both"), ("d", "f", "a", None, "row"), ("d", "f", None, 3, "line"), ("d", "f", None, None, "any")],
                                  "dataset string, field string, row_id string, line_no bigint, value string")
    got = {r.request_no: r.value for r in vault.keyed_fallback(asked, table).collect()}
    assert got == {1: "both", 2: "row", 3: "line", 4: "any", 5: None}


def requests(spark, plan, *stored, **options):
    table = spark.createDataFrame([("employees", "password", *r[:-1], 0, r[-1]) for r in stored], vault.VAULT)
    items = vault.attach_secrets(plan.items, vault.latest_secrets(table), "employees", ["password"])
    return {r.line_no: r for r in apply.request_rows(items, **options).collect()}


def test_requests(spark, plan):
    rows = requests(spark, plan, ("New|P|X|7", "s", "r", "t", 1))
    assert rows[3].method == "PUT" and rows[3].path == f"/managed/user/{rows[3].resource_id}"
    assert set(rows[3].payload.asDict()) == set(apply.PAYLOAD) and len(apply.PAYLOAD) == 14
    assert rows[3].payload.password == "s" and rows[3].payload.avatarId is None
    # an update has no password, which the strict payload demands
    assert rows[2].error_message == "Missing required fields for payload: password"
    assert requests(spark, plan, ("x", "s", "r", "t", 1), strict=False)[2].error_code is None
    assert requests(spark, plan, ("x", "s", "r", "t", 1))[3].error_code == "SECRET_REQUIRED"


def test_outcomes(spark, plan):
    ready = spark.createDataFrame([(i, op, "x", None) for i, op in enumerate(["create", "update", "create"])] + [(3, "create", "", "RESOURCE_ID_MISSING")],
                                  "line_no bigint, op string, resource_id string, error_code string")
    log = spark.createDataFrame([(0, 201, ""), (1, 403, ""), (2, 409, '{"e":"ResourceExists"}')], "line_no bigint, status int, body string")
    rows = apply.apply_outcome(ready, log)
    got = {r.line_no: (r.outcome, r.code) for r in rows.collect()}
    assert got == {0: ("created", None), 1: ("failed", "FORBIDDEN"), 2: ("failed", "CONFLICT"), 3: ("failed", "RESOURCE_ID_MISSING")}
    one = spark.range(1).selectExpr("5L as n")
    assert apply.apply_counters(rows, one.scalar()).first().asDict() == {"created": 1, "updated": 0, "skipped": 5, "failed": 3, "exit_status": 2}
    assert sorted(r.line_no for r in apply.stop_at_first_error(rows).collect()) == [0, 1]
    assert apply.first_actions(ready, 2).count() == 2
    dry = apply.apply_outcome(ready, log, dry_run=True)
    assert dry.where("outcome = 'failed'").count() == 1
    assert apply.classify_outcomes(log).where("line_no = 2").first().error_reason == "resourceexists"


def test_taken_id_is_renewed(spark):
    items = spark.createDataFrame([(1, "create", "id-1"), (2, "create", "free"), (3, "update", "id-1")], "line_no bigint, op string, resource_id string")
    spec = employees.enrich_spec()
    rows = {r.line_no: r for r in apply.retry_ids(items, users(spark, {}), spec).collect()}
    assert [rows[i].id_attempt for i in (1, 2, 3)] == [1, 0, 0]
    assert rows[1].resource_id != "id-1" and rows[3].resource_id == "id-1"
    assert apply.retry_ids(items, users(spark, {}), spec, retries=0).where("id_attempt is null").count() == 1


def test_second_run_has_nothing_to_do(spark, plan):
    raw = feed(spark, {}, {"full_name": "New P X", "raw_id": "7", "extra": "org_id=20;tab=T7"})
    target = users(spark, {"user_name": "old"}, {"_id": "z", "match_key": "zz", "usr_org_tab_num": "T7"})
    first = sync.plan_import(raw, target, orgs(spark, 20))
    after = staged(apply.apply_to_target(first.items, target).drop("op"), "after")
    second = sync.plan_import(raw, after, orgs(spark, 20)).summary.first()
    assert (second.planned_create, second.planned_update, second.skipped) == (0, 0, 2)


def test_apply_plan(spark, plan):
    target = users(spark, {"user_name": "old"})
    stored = spark.createDataFrame([("employees", "password", "New|P|X|7", "s", "r", "t", 0, 1)], vault.VAULT)
    outcome = {r.line_no: (r.outcome, r.code) for r in sync.apply_plan(plan.items, target, stored).outcome.collect()}
    assert outcome[3] == ("created", None) and outcome[2] == ("failed", "UNEXPECTED_ERROR")
    done = sync.apply_plan(plan.items, target, stored, strict=False)
    assert sorted(r.user_name for r in done.table.collect()) in (["mquint", "mquint"], ["mquint", "other"])
    stopped = sync.apply_plan(plan.items, target, stored, stop_on_first_error=True)
    assert [r.line_no for r in stopped.outcome.collect()] == [2] and stopped.table.first().user_name == "old"
    dry = sync.apply_plan(plan.items, target, stored, dry_run=True, max_actions=2)
    assert dry.outcome.where("code is null").count() == 2 and dry.table.count() == 1
    taken = users(spark, {"user_name": "old"}, {"_id": plan.items.where("op = 'create'").first().resource_id, "_ouid": 9, "match_key": "z"})
    refused = sync.apply_plan(plan.items, taken, stored, retries=0).outcome.where("line_no = 3").first()
    assert refused.code == "CONFLICT"
    assert sync.apply_plan(plan.items, taken, stored).outcome.where("line_no = 3").first().code is None


def test_no_secret_leaves_the_vault(spark, plan):
    shown = [str(r) for df in (plan.items, plan.summary) for r in df.collect()]
    assert not any("geheim" in s or "p3" in s for s in shown)
    path = new_folder(spark, "plan")
    artifacts.write_plan(plan.items, plan.summary, {"dataset": "employees", "run_id": "r"}, path)
    back = {r.line_no: r for r in artifacts.read_plan(spark, path).collect()}
    assert back[3].op == "create" and back[3].desired_state["email"] == "mara.quint@lumen.example"
    assert back[3].secret_fields == ["password"] and back[3].source_ref == {"match_key": "New|P|X|7"}
    text = artifacts.report_document(plan.decided, {"run_id": "r"}, 5).first().report
    assert json.loads(text)["summary"]["rows_total"] == 3


@pytest.mark.parametrize(
    ("body", "error"),
    [("[]", "root must be object"), ('{"meta":{"dataset":"d"},"items":{}}', "items must be list"),
     ('{"items":[]}', "dataset is missing in meta"), ('{"meta":{"dataset_name":"d"}}', None)],
)
def test_plan_documents(spark, body, error):
    row = artifacts.parse_plan_documents(spark.createDataFrame([(body,)], "body string")).first()
    assert row.plan_error == (error and f"Invalid plan format: {error}")


def test_nested_masks(spark):
    df = spark.sql(
        "select named_struct('Password', 'a', 'x', array(named_struct('token', 1, 'y', 2)), 'm', map('API_KEY', 'k', 'z', 'v')) as d, "
        "cast(null as struct<secret:string>) as n"
    )
    d = df.select(masking.mask_nested(df.d, df.schema["d"].dataType).alias("d"), masking.mask_nested(df.n, df.schema["n"].dataType).alias("n")).first()
    assert d.d.Password == "***" and d.d.x[0].token == "***" and d.d.x[0].y == 2 and d.n is None
    assert d.d.m == {"API_KEY": "***", "z": "v"}


def test_json_text_masks(spark):
    bodies = ['{"a":1,"Token":"x\\"y","b":{"secret": 5}}', '{"password":{"deep":"x"}}', '{"token":null}', "plain"]
    df = spark.createDataFrame([(b,) for b in bodies], "b string")
    got = [r.m for r in df.select(masking.mask_json_text(df.b).alias("m")).collect()]
    assert got == ['{"a":1,"Token":"***","b":{"secret": "***"}}', '{"password":"***"}', '{"token":null}', "plain"]


def _masked(value):
    """Recursive masking of a parsed document."""
    if isinstance(value, list):
        return [_masked(v) for v in value]
    if not isinstance(value, dict):
        return value
    return {k: (v if v is None else "***") if k.lower() in masking.SENSITIVE_KEYS else _masked(v) for k, v in value.items()}


def _document(draw, depth):
    """A random document whose strings look like keys, brackets and escapes."""
    kind = draw.random()
    if depth and kind < 0.4:
        return {draw.choice(["a", "Token", "secret", "b \"password\": [", "api_key", "password2", "\\", "é", "z"]): _document(draw, depth - 1) for _ in range(draw.randint(0, 5))}
    if depth and kind < 0.6:
        return [_document(draw, depth - 1) for _ in range(draw.randint(0, 4))]
    return draw.choice([None, True, False, 0, -1.5e-7, 12, "", "}", "]", '"secret":{', "x\\", "\u2028 \n", "token", {}, []])


def _spelled(text):
    """The same document with letters of names and strings written as escapes."""
    return text.replace("oken", "\\u006fken").replace("ecret", "\\u0065cret")


def test_nested_json_equals_recursive_masking(spark):
    draw = random.Random(5)
    documents = [_document(draw, 7) for _ in range(3000)]
    texts = [json.dumps(d, indent=draw.choice([None, 1]), ensure_ascii=draw.random() < 0.5) for d in documents]
    texts += [_spelled(t) for t in texts[:300]]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, b string").repartition(3)
    got = {r.i: r.m for r in df.select("i", masking.mask_json_text(df.b).alias("m")).collect()}
    for i, text in enumerate(texts):
        assert json.loads(got[i]) == _masked(json.loads(text)), text
    # what is not masked stays letter by letter
    assert all(got[i] == t for i, t in enumerate(texts) if json.loads(t) == _masked(json.loads(t)))


@pytest.mark.parametrize(
    ("body", "shown"),
    [
        ('{"a":1,"token":{"b":[1,{"c":"}', '{"a":1,"token":"***"'),
        ('{"a":1,"token":"cut off \\', '{"a":1,"token":"***"'),
        ('{"a":[{"password":["x"]},{"secret":{}}],"b":2}', '{"a":[{"password":"***"},{"secret":"***"}],"b":2}'),
        ('{"token":{"token":{"token":1}},"token":[]}', '{"token":"***","token":"***"}'),
        ('{"x":"\\u00zz","\\u00qtoken":1,"secret":[2]}', '{"x":"\\u00zz","\\u00qtoken":1,"secret":"***"}'),
        ("", ""),
        (None, None),
    ],
)
def test_odd_bodies(spark, body, shown):
    df = spark.createDataFrame([(body,)], "b string")
    assert df.select(masking.mask_json_text(df.b).alias("m")).first().m == shown


def test_large_and_deep_bodies_in_proportion(spark):
    deep = '{"a":' * 100_000 + "1" + "}" * 100_000
    many = ",".join(f'{{"secret":{{"n":[{i}]}},"i":{i}}}' for i in range(30_000))
    shown = ",".join(f'{{"secret":"***","i":{i}}}' for i in range(30_000))
    bodies = [f'{{"token":{deep},"z":{deep}}}', f"[{many}]"]
    start = time.perf_counter()
    assert [masking.mask_body(b, frozenset(masking.SENSITIVE_KEYS)) for b in bodies] == [f'{{"token":"***","z":{deep}}}', f"[{shown}]"]
    assert time.perf_counter() - start < 10


@pytest.mark.parametrize("unit", ["x", '\\\\"', "\\\\\\\\", 'a\\\\"b', "\\\\u00e9 "])
def test_long_texts_are_masked_without_recursion(spark, unit):
    unit = unit.replace("\\\\", "\\")
    long = unit * (1_000_000 // len(unit))
    body = json.dumps({"n": 1})[:-1] + f', "Token": "{long}", "note": "{long}", "secret": 12' + "}"
    df = spark.createDataFrame([(body,)], "b string")
    got = df.select(masking.mask_json_text(df.b).alias("m")).first().m
    assert got == '{"n": 1, "Token": "***", "note": "' + long + '", "secret": "***"}'


def test_apply_report(spark):
    rows = spark.createDataFrame([(2, "create", "a", "created", None), (3, "update", "b", "failed", "CONFLICT")], "line_no bigint, op string, resource_id string, outcome string, code string")
    found = {r.line_no: r for r in apply.apply_report_rows(rows).collect()}
    assert found[2].status == "OK" and found[2].errors == []
    assert [(e.stage, e.code, e.message) for e in found[3].errors] == [("APPLY", "CONFLICT", "update failed: CONFLICT")]
    assert found[3].context == {"op": "update", "resource_id": "b"}


def test_a_plan_kept_as_one_document(spark, tmp_path):
    good = {"row_id": "line:2", "line_no": 2, "op": "create", "resource_id": "r", "desired_state": {"email": "e", "password": "***"},
            "changes": {}, "source_ref": {"match_key": "k"}, "secret_fields": ["password"]}
    plan = {"meta": {"dataset": "d"}, "summary": None, "items": [good, "junk", None, [1], {"row_id": 5, "line_no": "x", "desired_state": []}]}
    (tmp_path / "plan.json").write_text(json.dumps(plan, indent=1))
    first, second = artifacts.read_plan_document(spark, str(tmp_path / "plan.json")).orderBy("pos").collect()
    assert (first.row_id, first.line_no, first.desired_state, first.source_ref) == ("line:2", 2, {"email": "e"}, {"match_key": "k"})
    assert (second.row_id, second.line_no, second.op, second.desired_state, second.secret_fields) == ("5", None, "", {}, [])
