"""The incremental run ends where the one-shot run ends."""

from helpers import feed, orgs, users

from feedplan.operators import vault
from feedplan.operators.apply import apply_to_target
from feedplan.plans import employees, sync
from feedplan.sources.snapshot_store import Changes, SnapshotStore
from feedplan.sources.staging import new_folder
from feedplan.streaming import incremental


def test_batches_equal_one_shot_and_repeat_safely(spark):
    people = [{"full_name": f"P{i} F M", "raw_id": str(i), "extra": f"org_id=20;tab=T{i}"} for i in range(6)]
    raw = feed(spark, {"login": "changed"}, *people)
    target, known = users(spark, {}), orgs(spark, 20)
    folder = new_folder(spark, "arrivals")
    for part in range(3):
        raw.where(f"line_no % 3 = {part}").drop("record_id").coalesce(1).write.mode("append").option("header", True).csv(f"{folder}/in")
    store = SnapshotStore(spark, f"{folder}/store")
    store.commit({incremental.DATASET: target}, "r", version=1)
    arrivals = incremental.read_arrivals(spark, f"{folder}/in", files_per_batch=1)
    incremental.incremental_sync(arrivals, store, known, f"{folder}/progress", "run", 2).awaitTermination()
    final = store.read(incremental.DATASET, incremental.snapshot_schema())
    once = apply_to_target(sync.plan_import(raw, target, known, employees.enrich_spec("run")).items, target).drop("op")
    known_columns = [c for c in final.columns if c not in ("_id",)]
    same = [sorted(map(str, df.select(known_columns).collect())) for df in (final, once)]
    assert same[0] == same[1] and final.count() == 7 and final.select("_id").distinct().count() == 7

    # a repeated batch reads the version before it and writes the same again
    last = store.current_version(incremental.DATASET)
    batch = raw.where("line_no % 3 = 0").drop("record_id")
    before = sorted(map(str, final.collect()))
    incremental.apply_batch(raw.drop("record_id"), last + 1, store, known, "run")
    incremental.apply_batch(batch, last + 1, store, known, "run")
    assert sorted(map(str, store.read(incremental.DATASET, incremental.snapshot_schema()).collect())) == before


def test_files_that_number_from_two_lose_nobody(spark):
    folder = new_folder(spark, "arrivals")
    for part in range(5):
        one = feed(spark, {"full_name": f"P{part} F M", "raw_id": str(part), "extra": f"password=p{part};org_id=20;tab=T{part}"})
        one.drop("record_id").coalesce(1).write.mode("append").option("header", True).csv(f"{folder}/in")
    store = SnapshotStore(spark, f"{folder}/store")
    arrivals = incremental.read_arrivals(spark, f"{folder}/in", files_per_batch=1)
    incremental.incremental_sync(arrivals, store, orgs(spark, 20), f"{folder}/progress", "run", vault=f"{folder}/vault").awaitTermination()
    final = store.read(incremental.DATASET, incremental.snapshot_schema())
    assert sorted(r.last_name for r in final.collect()) == [f"P{i}" for i in range(5)]
    assert final.select("_id").distinct().count() == 5 and store.current_version(incremental.DATASET) == 5
    assert sorted(r.value for r in vault.read_vault(spark, f"{folder}/vault").collect()) == [f"p{i}" for i in range(5)]


def test_a_repeated_batch_keeps_its_secrets(spark):
    folder = new_folder(spark, "repeated")
    store = SnapshotStore(spark, f"{folder}/store")
    raw = feed(spark, *[{"full_name": f"P{i} F M", "raw_id": str(i), "extra": f"org_id=20;tab=T{i}"} for i in range(3)]).drop("record_id")
    seen = []
    for _ in range(2):
        incremental.apply_batch(raw, 1, store, orgs(spark, 20), "run", f"{folder}/vault")
        seen.append(sorted((r.match_key, r.value) for r in vault.read_vault(spark, f"{folder}/vault").collect()))
    assert seen[0] == seen[1] and len(seen[0]) == 3
    assert store.read(incremental.DATASET, incremental.snapshot_schema()).count() == 3


def names(table):
    return {r._id: r.user_name for r in table.collect()}


def test_changes_replace_rows_of_their_buckets(spark):
    store = SnapshotStore(spark, new_folder(spark, "store"), buckets=4)
    schema = incremental.snapshot_schema()
    store.commit({"employees": users(spark, {"_id": "a"}, {"_id": "b"})}, "r", version=1)
    expected = {"a": "mquint", "b": "mquint"}
    for version, changed in enumerate([{"b": "two"}, {"c": "three"}, {"b": "four", "d": "four"}, {"a": "five"}], 2):
        changes = users(spark, *[{"_id": i, "user_name": n} for i, n in changed.items()])
        for _ in range(2):  # a repeated commit changes nothing
            store.merge({"employees": Changes(changes)}, "r", version=version)
        expected |= changed
        assert names(store.read("employees", schema)) == expected and store.read("employees", schema).count() == len(expected)
    assert names(store.read("employees", schema, before=3)) == {"a": "mquint", "b": "two"}


def test_a_small_batch_reads_and_writes_its_buckets_only(spark):
    """One key in a hundred: files of other buckets are neither read nor written."""
    store = SnapshotStore(spark, new_folder(spark, "store"), buckets=64)
    rows = spark.range(20_000).selectExpr("id as k", "id * 2 as v")
    store.commit({"numbers": rows}, "r")
    before = store.folders("numbers")
    few = rows.where("k in (17, 4711)").selectExpr("k", "-v as v")
    touched = store.touched("numbers", few)
    assert 0 < len(touched) <= 2
    read = store.read("numbers", rows.schema, only=touched).inputFiles()
    assert read and all(any(f"/bucket={b}/" in f for b in touched) for f in read)
    store.merge({"numbers": Changes(few)}, "r")
    after = store.folders("numbers")
    assert {b for b in before if before[b] != after[b]} == set(touched)
    assert store.read("numbers", rows.schema).where("v < 0").count() == 2 and store.read("numbers", rows.schema).count() == 20_000
    # however many versions there were, a reader scans one folder for each bucket
    for _ in range(3):
        store.merge({"numbers": Changes(few)}, "r")
    assert len(store.folders("numbers")) == 64 and store.read("numbers", rows.schema).count() == 20_000


def test_removed_rows(spark):
    store = SnapshotStore(spark, new_folder(spark, "store"), buckets=8)
    rows = spark.range(100).selectExpr("id as k", "'old' as v")
    store.commit({"numbers": rows}, "r")
    changed = rows.where("k < 2 or k = 50").selectExpr("k", "'new' as v").union(spark.sql("select 200L, 'new'"))
    removed = spark.range(50, 100).selectExpr("id as anything")
    store.merge({"numbers": Changes(changed, removed)}, "r")
    found = {r.k: r.v for r in store.read("numbers", rows.schema).collect()}
    assert found == {**{k: "old" for k in range(2, 50)}, 0: "new", 1: "new", 50: "new", 200: "new"}  # changed and removed: stays
    store.merge({"numbers": Changes(rows.limit(0), spark.range(300).toDF("k"))}, "r")
    assert store.read("numbers", rows.schema).count() == 0 and store.folders("numbers") == {}
    assert store.read("numbers", rows.schema, before=3).count() == 52
    store.merge({"numbers": Changes(rows.limit(0))}, "r")  # nothing changed
    assert store.current_version("numbers") == 4


def test_bucket_does_not_depend_on_the_integer_type(spark):
    store = SnapshotStore(spark, new_folder(spark, "store"))
    store.commit({"n": spark.range(50).selectExpr("id as k", "1 as v")}, "r")
    assert store.touched("n", spark.range(50).toDF("k")) == store.touched("n", spark.range(50).selectExpr("cast(id as int) as k"))
