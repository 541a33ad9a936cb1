"""Mapping to plan on small feeds, and the plan counts of the test tables."""

import pytest
from helpers import GOOD, feed, orgs, users

from feedplan.functions import diagnostics as dx
from feedplan.operators import apply, planning, report, validate
from feedplan.operators.diff import as_flag
from feedplan.operators.enrich import allocate_codes, allocate_ids, new_code, new_id, sized
from feedplan.operators.matching import match_key
from feedplan.operators.normalize import NormalizeRule, normalize
from feedplan.plans import employees, feeds, sync

SF = "/root/testdata/sf0.001"


def codes(rows):
    return {r.line_no: [e.code for e in r.errors] for r in rows.collect()}


def test_valid_row(spark):
    rows = sync.validated(feed(spark, {}), users(spark), orgs(spark, 20))
    row = rows.first()
    assert row.match_key == "Quint|Mara|Ilse|4711" and row.organization_id == 20 and row.errors == []


def test_mapping_keeps_rows_without_a_name(spark):
    row = sync.mapped(feed(spark, {"full_name": ""})).first()
    assert row.last_name is None and row.errors == [] and row.secrets == {"password": "geheim"}


def test_row_of_nulls_has_no_key(spark):
    rows = sync.enriched(feed(spark, dict.fromkeys(GOOD)), users(spark))
    assert codes(rows) == {2: ["MATCH_KEY_MISSING"]}


@pytest.mark.parametrize(
    ("change", "expected"),
    [
        ({"email_or_phone": "mara.quint@lumen"}, ["INVALID_EMAIL"]),
        ({"extra": "password=x;org_id=999;tab=1"}, ["ORG_NOT_FOUND"]),
        ({"extra": "password=x;org_id=-1;tab=1"}, ["INVALID_INT", "ORG_NOT_FOUND"]),
        ({"login": None}, ["REQUIRED_FIELD_MISSING"]),
        ({"extra": "org_id=20;tab=1"}, []),  # the password is generated
        ({"email_or_phone": None, "contacts": None}, ["REQUIRED_FIELD_MISSING"] * 2),
    ],
)
def test_validation(spark, change, expected):
    rows = sync.validated(feed(spark, change), users(spark), orgs(spark, 20), stage=sync.in_place)
    assert codes(rows) == {2: expected}


def test_normalize_errors_add_up(spark):
    raw = feed(spark, {"flags": "disabled=false", "extra": "org_id=bad;tab=1"})
    mapped = sync.mapped(raw).withColumn("is_logon_disable", planning.F.lit("perhaps"))
    rows = normalize(mapped, [*employees.normalize_rules(), NormalizeRule("x", "avatar_id", required=True)])
    assert codes(rows) == {2: ["INVALID_BOOLEAN", "INVALID_INT", "REQUIRED_FIELD_MISSING"]}


def test_earlier_errors_stop_later_stages(spark):
    rows = sync.enriched(feed(spark, {"extra": "org_id=bad", "full_name": ""}), users(spark))
    assert codes(rows) == {2: ["INVALID_INT"]}


def plan(spark, raw, target):
    done = sync.plan_import(raw, target, orgs(spark, 20))
    return done, {r.line_no: r.decision for r in done.decided.collect()}


def test_create_update_skip_conflict(spark):
    raw = feed(
        spark,
        {},
        {"full_name": "New Person X", "raw_id": "7", "extra": "org_id=20;tab=T7"},
        {"full_name": "Chg Person X", "raw_id": "8", "extra": "org_id=20;tab=T8", "login": "new"},
        {"full_name": "Two Person X", "raw_id": "9", "extra": "org_id=20;tab=T9"},
    )
    changed = {"_id": "id-8", "_ouid": 8, "match_key": "Chg|Person|X|8", "usr_org_tab_num": "T8", "last_name": "Chg",
               "first_name": "Person", "middle_name": "X", "personnel_number": "8", "phone": "+49 30 555 123"}
    twin = {"match_key": "Two|Person|X|9", "usr_org_tab_num": "T9"}
    target = users(spark, {}, changed, {"_id": "a", **twin}, {"_id": "b", **twin})
    done, decisions = plan(spark, raw, target)
    assert decisions == {2: "skip", 3: "create", 4: "update", 5: "conflict"}
    items = {r.line_no: r for r in done.items.collect()}
    assert items[4].changes == {"user_name": "new", "phone": "+49 30 555123"} and items[4].resource_id == "id-8"
    assert items[3].secret_fields == ["password"] and items[4].secret_fields == []
    assert "password" not in items[3].desired_state.asDict()
    assert done.summary.first().asDict() == {
        "rows_total": 4, "valid_rows": 3, "failed_rows": 1, "planned_create": 1, "planned_update": 1, "skipped": 1,
    }


def test_deleted_records_do_not_match_unless_asked(spark):
    target = users(spark, {"account_status": "deleted"})
    rows = sync.decided(feed(spark, {}), target, orgs(spark, 20))
    assert rows.first().decision == "create"
    rows = sync.decided(feed(spark, {}), target, orgs(spark, 20), include_deleted=True)
    assert rows.first().decision == "skip"


def test_same_key_and_code_twice_in_a_feed_is_valid(spark):
    _, decisions = plan(spark, feed(spark, {}, {}), users(spark))
    assert decisions == {2: "create", 3: "create"}
    twins = validate.duplicate_report(sync.enriched(feed(spark, {}, {}), users(spark)), ("match_key", "usr_org_tab_num"))
    assert sorted((r.key, r.n_rows, r.first_line_no) for r in twins.collect()) == [
        ("match_key", 2, 2), ("usr_org_tab_num", 2, 2),
    ]


def test_manager_modes(spark):
    raw = feed(spark, {"manager": "manager: 5"}, {"manager": "manager: 6"}, {"manager": "manager: 7"}, {})
    target = users(
        spark, {"_id": "a", "_ouid": 5, "match_key": "5"}, {"_id": "b", "_ouid": 6, "match_key": "6"},
        {"_id": "c", "_ouid": 6, "match_key": "6"}, {"_id": "d", "_ouid": None, "match_key": "9"},
    )

    def run(mode):
        rows = sync.enriched(raw, target, employees.enrich_spec(manager_mode=mode))
        return {r.line_no: (r.manager_id, [e.code for e in r.errors]) for r in rows.collect()}

    expected = {2: (5, []), 3: (None, ["MANAGER_CONFLICT"]), 4: (None, ["MANAGER_NOT_FOUND"]), 5: (None, [])}
    assert run("match_key") == expected and run("ouid") == expected
    assert run("none")[2] == (None, ["MANAGER_LOOKUP_MISSING"])


def test_taken_ids_and_codes_move_on(spark):
    spec = employees.enrich_spec("t")
    one = spark.createDataFrame([(2,), (3,), (4,)], "line_no bigint")
    drawn = {
        r.line_no: r for r in one.selectExpr("line_no", *[f"{new_id(spec, n)} as i{n}" for n in (1, 2, 3)],
                                             *[f"{new_code(spec, n)} as c{n}" for n in (1, 2, 3)]).collect()
    }
    rows = one.selectExpr("line_no", "concat('k', line_no) as match_key", "if(line_no = 2, 'X', null) as usr_org_tab_num", f"{dx.NONE} as errors")
    target = users(
        spark, {"_id": drawn[2].i1, "match_key": "other", "usr_org_tab_num": "X"},
        {"_id": drawn[3].i1, "match_key": "other", "usr_org_tab_num": drawn[2].c2},
        {"_id": drawn[3].i2, "match_key": "other", "usr_org_tab_num": drawn[4].c1},
        {"_id": drawn[3].i3, "match_key": "k3", "usr_org_tab_num": drawn[3].c1},
    )
    assert {tuple(r) for r in allocate_ids(rows, target, spec).collect()} == {(2, 2), (3, 0)}
    # line 3 keeps what its own record holds already
    assert {tuple(r) for r in allocate_codes(rows, target, spec).collect()} == {(2, 3), (3, 1), (4, 2)}


@pytest.mark.parametrize("run", ["t", "u", "v", "w"])
def test_codes_are_shared_out_attempt_by_attempt(spark, run):
    spec = employees.enrich_spec(run, code_width=1)
    rows = spark.range(2, 14).selectExpr(
        "id as line_no", "concat('k', id) as match_key", "cast(null as string) as usr_org_tab_num", f"{dx.NONE} as errors"
    )
    drawn = {r.line_no: r for r in rows.selectExpr("line_no", *[f"{new_code(spec, n)} as c{n}" for n in (1, 2, 3)]).collect()}
    expected = {}
    for attempt in (1, 2, 3):
        for line in sorted(drawn):
            code = drawn[line][f"c{attempt}"]
            if line not in expected and code not in {drawn[k][f"c{a}"] for k, a in expected.items()}:
                expected[line] = attempt
    got = {r.line_no: r.code_pick for r in allocate_codes(rows, users(spark), spec).collect()}
    assert got == {line: expected.get(line, 0) for line in drawn}


def test_code_width_follows_the_feed(spark):
    widths = [sized(employees.enrich_spec(), spark.range(n)).code_width for n in (0, 10, 100_000, 1_000_000)]
    assert widths == [8, 8, 9, 10] and sized(employees.enrich_spec(code_width=4), spark.range(10**6)).code_width == 4


def test_files_that_number_alike_stay_apart(spark):
    raw = feed(
        spark, {"manager": "manager: 5", "extra": "org_id=20;tab=T1", "raw_id": "1"},
        {"manager": "manager: 7", "extra": "org_id=20;tab=T2", "raw_id": "2"}, {"extra": "org_id=bad", "raw_id": "3"},
    )
    raw = raw.withColumn("source_id", planning.F.concat(planning.F.lit("f"), planning.F.col("line_no"))).withColumn("line_no", planning.F.lit(2).cast("bigint"))
    target = users(spark, {"_id": "a", "_ouid": 5, "match_key": "5"}, {"_id": "b", "_ouid": 9, "match_key": "9", "usr_org_tab_num": "T2"})
    rows = {r.source_id: r for r in sync.enriched(raw, target).collect()}
    assert len({r.resource_id for r in rows.values() if r.resource_id}) == 2
    assert (rows["f2"].manager_id, rows["f2"].usr_org_tab_num, rows["f2"].code_generated) == (5, "T1", False)
    assert rows["f3"].code_generated and [e.code for e in rows["f3"].errors] == ["MANAGER_NOT_FOUND"]
    assert [e.code for e in rows["f4"].errors] == ["INVALID_INT"]


def test_repeated_rows_fail(spark):
    with pytest.raises(ValueError, match="share source_id and line_no"):
        sync.enriched(feed(spark, {}, {}).withColumn("line_no", planning.F.lit(2).cast("bigint")), users(spark))


def test_integer_flags_differ_from_zero_only(spark):
    forms = {2: True, 1: True, 0: False, -1: True, None: None}
    df = spark.createDataFrame([(v,) for v in forms], "flag int")
    assert [r.f for r in df.selectExpr(f"{as_flag('flag')} as f").collect()] == list(forms.values())


def test_match_key_modes(spark):
    df = spark.createDataFrame([(" a ", None), ("x  y", "z")], "p string, q string")
    got = df.selectExpr(f"{match_key(['p', 'q'])} as s", f"{match_key(['p', 'q'], strict=False)} as l").collect()
    assert [tuple(r) for r in got] == [(None, "a|"), ("x y|z", "x y|z")]


def test_plan_counts_of_the_test_tables(spark):
    raw, target, known = feeds.raw_feed(spark, SF), feeds.target(spark, SF), feeds.orgs(spark, SF)
    done = sync.plan_import(raw, target, known)
    s = done.summary.first()
    assert (s.rows_total, s.failed_rows, s.planned_create, s.planned_update, s.skipped) == (129, 33, 39, 6, 51)
    lost = report.error_histogram(sync.enriched(raw, target))
    assert {r.code: r.n for r in lost.collect()} == {"INVALID_INT": 5, "MATCH_KEY_MISSING": 10, "MANAGER_NOT_FOUND": 6}
    # order and partitioning of the feed do not matter
    again = sync.plan_import(raw.orderBy("line_no", ascending=False).repartition(7), target, known)
    columns = ["line_no", "decision", "resource_id", "usr_org_tab_num"]
    assert sorted(map(tuple, done.decided.select(*columns).collect()), key=str) == sorted(
        map(tuple, again.decided.select(*columns).collect()), key=str
    )


def test_report(spark):
    rows = sync.decided(feeds.raw_feed(spark, SF), feeds.target(spark, SF), feeds.orgs(spark, SF))
    s = report.report_summary(rows).first()
    assert (s.rows_total, s.rows_passed, s.rows_blocked, s.status) == (129, 45, 33, "PARTIAL")
    assert report.report_items(rows, 3).count() == 3
    assert report.items_truncated(rows, 3).first().items_truncated is True
    assert report.items_truncated(rows, 100).first().items_truncated is False


def test_order_over_several_sources(spark):
    """A line number says nothing without its source: order, truncation, stop and references use both."""
    rows = spark.createDataFrame(
        [(s, n, "FAILED" if (s, n) in (("a", 2), ("b", 2)) else "OK", "m") for s in ("b", "a") for n in (1, 2, 3)],
        "source_id string, line_no bigint, status string, match_key string",
    ).selectExpr("*", "cast(array() as array<struct<stage:string,code:string,field:string,message:string>>) as errors", "cast(array() as array<struct<stage:string,code:string,field:string,message:string>>) as warnings")
    assert [(r.source_id, r.line_no) for r in report.report_items(rows, 4, include_ok=True).collect()] == [("a", 1), ("a", 2), ("a", 3), ("b", 1)]
    assert report.items_truncated(rows, 1).first().items_truncated is True and report.items_truncated(rows, 2).first().items_truncated is False
    assert sorted(r.row_ref.row_id for r in report.item_rows(report.report_items(rows, 2)).collect()) == ["a#line:2", "b#line:2"]
    outcome = rows.selectExpr("source_id", "line_no", "if(status = 'OK', 'created', 'failed') as outcome")
    assert sorted((r.source_id, r.line_no) for r in apply.stop_at_first_error(outcome).collect()) == [("a", 1), ("a", 2)]
    assert apply.stop_at_first_error(outcome.where("outcome = 'created'")).count() == 4
    assert sorted((r.source_id, r.line_no) for r in apply.first_actions(outcome, 4).collect()) == [("a", 1), ("a", 2), ("a", 3), ("b", 1)]
