"""Refresh against a sequential walk, store versions, page rules."""

import json
import random

import pytest
from helpers import ORGS, USERS, orgs, users

from feedplan.operators import snapshot
from feedplan.plans import feeds, sync
from feedplan.sources import pages
from feedplan.sources.snapshot_store import SnapshotStore
from pyspark.sql import types as T
from feedplan.sources.staging import new_folder, staged


def person(i, **changes):
    item = {"_id": f"S{i}", "_ouid": i, "lastName": f"N{i}", "firstName": "F", "middleName": "M", "personnelNumber": str(i),
            "mail": f"{i}@x.y", "userName": f"u{i}", "usrOrgTabNum": f"T{i}", "organizationId": 1}
    item.update(changes)
    return {k: v for k, v in item.items() if v is not ...}


def dump(spark, *bodies):
    return spark.createDataFrame([(n + 1, json.dumps(b)) for n, b in enumerate(bodies)], "page bigint, body string")


def test_two_pages_and_deleted_records(spark):
    first = [person(1), person(2, accountStatus="Deleted"), person(3, deletionDate="2024-01-01")]
    done = sync.refresh("employees", dump(spark, {"items": first}, [person(4, deletionDate="null")]), users(spark), page_size=3)
    assert done.counters.first().asDict() == {
        "dataset": "employees", "inserted": 2, "updated": 0, "failed": 0, "skipped": 2, "pages": 2,
    }
    assert sorted(r._id for r in done.table.collect()) == ["S1", "S4"]


def test_inserted_then_updated(spark):
    one = sync.refresh("employees", dump(spark, [person(1, phone="+111")]), users(spark), page_size=5)
    assert [(r.op, r.phone) for r in one.table.collect()] == [("inserted", "+111")]
    two = sync.refresh("employees", dump(spark, [person(1, phone="+222")]), one.table.drop("op"), page_size=5)
    assert [(r.op, r.phone) for r in two.table.collect()] == [("updated", "+222")]


@pytest.mark.parametrize(
    ("changes", "message"),
    [
        ({"mail": ...}, "Missing required field: mail"),
        ({"_id": None, "id": "x"}, "Missing required field: _id"),  # the first present name counts
        ({"_id": ..., "id": "x"}, None),
        ({"_ouid": "12x"}, "_ouid is no integer"),
        ({"_ouid": True}, "_ouid is no integer"),
        ({"_ouid": " 12 "}, None),
        ({"_ouid": " "}, "Missing required field: _ouid"),
        ({"isLogonDisabled": "maybe"}, "Invalid boolean value for is_logon_disabled"),
        ({"isLogonDisabled": 2}, None),
        ({"organizationId": "a"}, "organization_id is no integer"),
        ({"managerId": "a"}, "manager_ouid is no integer"),
        ({"lastName": " "}, "Missing required field: last_name"),
    ],
)
def test_record_mapping(spark, changes, message):
    items = pages.explode_records(pages.parse_pages(dump(spark, [person(1, **changes)])))
    assert snapshot.map_users(items).first().map_error == message


def test_org_mapping(spark):
    items = pages.explode_records(pages.parse_pages(dump(spark, [{"id": 5, "code": " c "}, {"_ouid": None, "id": 6}])))
    rows = snapshot.map_orgs(items).orderBy("pos").collect()
    assert [(r._ouid, r.code, r.map_error) for r in rows] == [(5, "c", None), (None, None, "Organization must contain _ouid")]


def sequential(records, known):
    """Uniqueness the slow way; updates do not free the values they leave."""
    held, bad = [dict(), dict()], []
    for _id, ouid, key in known:
        held[0][ouid], held[1][key] = _id, _id
    for pos, _id, ouid, key in records:
        if held[0].get(ouid, _id) != _id:
            bad.append((pos, "_ouid"))
        elif held[1].get(key, _id) != _id:
            bad.append((pos, "match_key"))
        else:
            held[0].setdefault(ouid, _id)
            held[1].setdefault(key, _id)
    return bad


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_uniqueness_like_a_sequential_read(spark, seed):
    rng = random.Random(seed)
    known = [(f"K{i}", 100 + i, f"key{i}") for i in range(4)]
    records = [
        (p, rng.choice(["K0", "K1"] + [f"R{n}" for n in range(9)]), rng.randint(96, 110), f"key{rng.randint(0, 14)}")
        for p in range(40)
    ]
    good = spark.createDataFrame(records, "ingest_pos bigint, _id string, _ouid bigint, match_key string")
    existing = spark.createDataFrame(known, "_id string, _ouid bigint, match_key string")
    got = {r.ingest_pos for r in snapshot.unique_violations(good, existing).collect()}
    assert got == {pos for pos, _ in sequential(records, known)}


def violations(spark, records, known=()):
    good = spark.createDataFrame(records, "ingest_pos bigint, _id string, _ouid bigint, match_key string")
    existing = spark.createDataFrame(list(known), "_id string, _ouid bigint, match_key string")
    return sorted((r.ingest_pos, r.taken_by) for r in snapshot.unique_violations(good, existing).collect())


def test_a_chain_ends_in_logarithmic_rounds(spark, monkeypatch):
    """Each record shares a value with the one before it and another with the one behind it."""
    n, written = 10_000, []
    chain = [(i, f"R{i}", (i + 1) // 2, f"key{i // 2}") for i in range(n)]
    monkeypatch.setattr(snapshot, "staged", lambda df, name: (written.append(name), staged(df, name))[1])
    assert violations(spark, chain) == sequential(chain, [])
    assert written.count("contested") <= 4 and written.count("pointers") <= 16


@pytest.mark.parametrize("seed", [4, 5])
def test_chains_that_fork_and_meet(spark, seed):
    """Chains of several lengths, with records that wait for two others and values that many share."""
    rng = random.Random(seed)
    records = []
    for _ in range(6):
        base = 1000 * len(records)
        for i in range(rng.randint(2, 25)):
            pos = len(records)
            records.append((pos, f"R{pos}" if rng.random() < 0.9 else "same", base + (i + 1) // 2, f"key{base + i // 2}"))
    records += [(len(records) + i, f"T{i}", rng.choice(records)[2], rng.choice(records)[3]) for i in range(25)]
    assert [p for p, _ in violations(spark, records)] == [p for p, _ in sequential(records, [])]


def snapshot_schema(ddl):
    return T.StructType.fromDDL(ddl)


def test_page_rules(spark):
    parsed = pages.parse_pages(dump(spark, {"data": [1, 2]}, {"items": {}, "result": [3]}, [4, 5]))
    read = pages.pages_read(parsed, page_size=2).orderBy("page").collect()
    assert [(r.page, r.n_records) for r in read] == [(1, 2), (2, 1)]
    full = pages.pages_read(pages.parse_pages(dump(spark, [1, 2], [3, 4], [5])), 2, max_pages=2).orderBy("page").collect()
    assert [r.page_error for r in full] == [None, "MAX_PAGES_EXCEEDED"]
    empty = pages.pages_read(pages.parse_pages(dump(spark, [1, 2], [])), 2).collect()
    assert [r.page for r in empty] == [1]


def test_bad_page_fails_the_refresh(spark):
    broken = spark.createDataFrame([(1, '{"items":[]}'), (2, "<html>")], "page bigint, body string")
    with pytest.raises(Exception, match="INVALID_JSON"):
        pages.require_good_pages(pages.parse_pages(broken)).select("records").collect()
    shapes = {'{"items":[]}': None, "[1]": None, "<html>": "INVALID_JSON", "": "INVALID_JSON", "{}": "INVALID_ITEMS_FORMAT", '{"items":{}}': "INVALID_ITEMS_FORMAT", "5": "INVALID_ITEMS_FORMAT"}
    rows = pages.parse_pages(spark.createDataFrame([(i, b) for i, b in enumerate(shapes)], "page bigint, body string"))
    assert [r.page_error for r in rows.orderBy("page").collect()] == list(shapes.values())


def test_store_versions(spark):
    import pyspark.sql.types as T

    store = SnapshotStore(spark, new_folder(spark, "store"))
    schemas = {"employees": T._parse_datatype_string(USERS), "organizations": T._parse_datatype_string(ORGS)}
    assert store.read("employees", schemas["employees"]).count() == 0
    sync.refresh_snapshot(
        store, {"organizations": dump(spark, [{"id": 20}]), "employees": dump(spark, [person(1), person(2)])}, "r1", page_size=9
    )
    assert {r.dataset: r.n_rows for r in store.status(schemas).collect()} == {"employees": 2, "organizations": 1}
    store.commit({"employees": users(spark, {})}, "r2")
    assert store.read("employees", schemas["employees"]).count() == 1
    assert store.read("employees", schemas["employees"], before=2).count() == 2
    first = {r.dataset: r.meta for r in store.manifest().where("version = 1").collect()}
    assert first["employees"]["count_total"] == "2" and first["employees"]["last_refresh_items"] == "2"
    assert set(first["employees"]) >= {"last_refresh_at", "last_refresh_run_id", "last_refresh_pages"}
    assert store.clear(schemas, "r3") == {"employees": 1, "organizations": 1}
    assert store.read("employees", schemas["employees"]).count() == 0


def test_refresh_writes_what_changed_and_removes_what_is_stale(spark):
    store = SnapshotStore(spark, new_folder(spark, "store"), buckets=32)
    schema = snapshot_schema(USERS)
    people = [person(i) for i in range(1, 9)]
    sync.refresh_snapshot(store, {"employees": dump(spark, people)}, "r1", page_size=9)
    before = store.folders("employees")
    same = sync.refresh_snapshot(store, {"employees": dump(spark, people)}, "r2", page_size=9)
    assert same == {"employees": 2} and store.folders("employees") == before
    key = store.read("employees", schema).orderBy("_ouid").first()._id
    sync.refresh_snapshot(store, {"employees": dump(spark, [{**people[0], "phone": "1"}, *people[1:6]])}, "r3", page_size=9)
    after = store.folders("employees")
    assert {b for b in before if before[b] != after[b]} == set(store.touched("employees", spark.createDataFrame([(key,)], "k string")))
    assert store.read("employees", schema).count() == 8
    sync.refresh_snapshot(store, {"employees": dump(spark, people[:6])}, "r4", page_size=9, remove_stale=True)
    assert store.read("employees", schema).count() == 6
    meta = {r.version: r.meta for r in store.manifest().collect()}
    assert meta[4]["count_total"] == "6" and meta[3]["count_total"] == "8" and meta[4]["last_refresh_items"] == "6"


def test_differing_records(spark):
    old = users(spark, {"_id": "a", "phone": None}, {"_id": "b", "phone": "1"}, {"_id": "c"})
    new = users(spark, {"_id": "a", "phone": None}, {"_id": "b", "phone": None}, {"_id": "d"})
    assert sorted(r._id for r in snapshot.differing(new, old).collect()) == ["b", "d"]


def test_refresh_counts_of_the_supplier_table(spark):
    sf = "/root/testdata/sf0.01"
    tables = feeds.load(spark, sf, "supplier")
    records = spark.sql(feeds.items_sql("{supplier}", "s_suppkey", "s_nationkey", "s_suppkey % 100 <> 79"), **tables)
    known = {c: e.replace("c_custkey", "k") for c, e in feeds.KNOWN_USERS.items()}
    columns = [f"{known.get(c, 'null')} as {c}" for c in snapshot.USER_COLUMNS]
    existing = spark.createDataFrame([], USERS).union(records.where("k % 3 = 0").selectExpr(*columns))
    done = sync.refresh("employees", feeds.as_pages(records), existing, page_size=20)
    c = done.counters.first()
    assert (c.inserted, c.updated, c.skipped, c.failed, c.pages) == (38, 23, 7, 11, 4)
    assert (existing.count(), done.table.count()) == (34, 72)
    assert snapshot.stale_rows(orgs(spark, 1, 2), orgs(spark, 2), "_ouid").count() == 1
