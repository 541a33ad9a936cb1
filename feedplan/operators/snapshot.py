"""Snapshot maintenance: record mapping, uniqueness, upsert and refresh."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedplan.functions import diagnostics as dx
from feedplan.functions.text import (
    is_deleted,
    lenient_bool,
    normalize_whitespace,
    quoted,
    strict_int,
    trim_to_null,
)
from feedplan.operators.lookup import lookup
from feedplan.operators.matching import match_key
from feedplan.sources.staging import staged

# Columns of the snapshots.
USER_COLUMNS = {
    "_id": "string",
    "_ouid": "bigint",
    "personnel_number": "string",
    "last_name": "string",
    "first_name": "string",
    "middle_name": "string",
    "match_key": "string",
    "mail": "string",
    "user_name": "string",
    "phone": "string",
    "usr_org_tab_num": "string",
    "organization_id": "bigint",
    "account_status": "string",
    "deletion_date": "string",
    "_rev": "string",
    "manager_ouid": "bigint",
    "is_logon_disabled": "int",
    "position": "string",
    "updated_at": "string",
}
ORG_COLUMNS = {
    "_ouid": "bigint",
    "code": "string",
    "name": "string",
    "parent_id": "bigint",
    "updated_at": "string",
}

# Names under which a target record may hold a field.  The
# first name that is present counts, even when its value is null.
USER_NAMES = {
    "_id": ("_id", "id"),
    "_ouid": ("_ouid", "ouid", "userId"),
    "last_name": ("last_name", "lastName"),
    "first_name": ("first_name", "firstName"),
    "middle_name": ("middle_name", "middleName"),
    "personnel_number": ("personnel_number", "personnelNumber"),
    "mail": ("mail", "email"),
    "user_name": ("user_name", "userName", "username", "login"),
    "usr_org_tab_num": ("usr_org_tab_num", "usrOrgTabNum"),
    "organization_id": ("organization_id", "organizationId", "org_id", "orgId"),
    "phone": ("phone", "mobile"),
    "account_status": ("account_status", "accountStatus"),
    "deletion_date": ("deletion_date", "deletionDate"),
    "_rev": ("_rev", "rev"),
    "manager_ouid": ("manager_ouid", "managerId", "manager_id"),
    "is_logon_disabled": ("is_logon_disabled", "isLogonDisabled"),
    "position": ("position",),
    "updated_at": ("updated_at", "updatedAt"),
}
ORG_NAMES = {
    "_ouid": ("_ouid", "ouid", "id"),
    "code": ("code",),
    "name": ("name",),
    "parent_id": ("parent_id", "parentId"),
    "updated_at": ("updated_at", "updatedAt"),
}
# The order in which a user record is checked.
USER_REQUIRED = (
    "_id", "_ouid", "last_name", "first_name", "middle_name", "personnel_number",
    "mail", "user_name", "usr_org_tab_num", "organization_id",
)
DELETED_NAMES = (("accountStatus", "account_status"), ("deletionDate", "deletion_date"))


def present(names: Sequence[str], item: str = "item") -> str:
    """Value under the first present name (SQL text); a JSON null is a value."""
    return f"coalesce({', '.join(f"try_variant_get({item}, '$.{n}', 'variant')" for n in names)})"


def as_text(value: str) -> str:
    return trim_to_null(f"cast({value} as string)")


def as_int(value: str) -> str:
    """Integer of a number or of a text in integer form, else NULL."""
    text = strict_int(f"cast({value} as string)")
    return (
        f"case when schema_of_variant({value}) = 'STRING' then {text} "
        f"when schema_of_variant({value}) <> 'BOOLEAN' then try_variant_get({value}, '$', 'bigint') end"
    )


def as_flag(value: str) -> str:
    """1 / 0 of a flag, an integer or a flag word, else NULL."""
    return (
        f"case when schema_of_variant({value}) in ('BOOLEAN', 'STRING') "
        f"then cast({lenient_bool(f'cast({value} as string)')} as int) "
        f"when schema_of_variant({value}) = 'BIGINT' then cast(try_variant_get({value}, '$', 'bigint') <> 0 as int) end"
    )


def first_message(*checks: tuple[str, str]) -> str:
    """Message of the first check that fails."""
    return "case " + " ".join(f"when {failed} then {quoted(text)}" for failed, text in checks) + " end"


def _read_fields(
    items: DataFrame, names: dict[str, Sequence[str]], whole: Sequence[str], flags: Sequence[str] = ()
) -> DataFrame:
    """Typed fields of ``item`` plus ``bad_<field>`` for unreadable numbers and
    flags.  Three projections, so that every value is looked up once."""
    raw = items.selectExpr("*", *[f"{present(n)} as v_{c}" for c, n in names.items()])
    forms = {c: as_int if c in whole else as_flag if c in flags else as_text for c in names}
    typed = raw.selectExpr("*", *[f"{forms[c](f'v_{c}')} as {c}" for c in names])
    # blank texts are no bad integers, but bad flags
    bad = [f"{c} is null and {as_text(f'v_{c}')} is not null as bad_{c}" for c in whole]
    bad += [f"{c} is null and cast(v_{c} as string) is not null as bad_{c}" for c in flags]
    return typed.selectExpr("*", *bad)


def map_users(items: DataFrame) -> DataFrame:
    """User columns of target records, with ``item_key``, ``is_deleted`` and
    ``map_error`` (NULL for a good record)."""
    whole = ("_ouid", "organization_id", "manager_ouid")
    typed = _read_fields(items, USER_NAMES, whole, ("is_logon_disabled",))
    missing = {c: (f"{c} is null", f"Missing required field: {c}") for c in USER_REQUIRED}
    error = first_message(
        ("bad__ouid", "_ouid is no integer"),
        *[missing[c] for c in USER_REQUIRED[:-1]],
        ("bad_organization_id", "organization_id is no integer"),
        missing["organization_id"],
        ("bad_manager_ouid", "manager_ouid is no integer"),
        ("bad_is_logon_disabled", "Invalid boolean value for is_logon_disabled"),
    )
    tidy = ("last_name", "first_name", "middle_name", "mail", "user_name", "usr_org_tab_num")
    key = match_key(("last_name", "first_name", "middle_name", "personnel_number"))
    columns = {
        c: key if c == "match_key" else normalize_whitespace(c) if c in tidy else c for c in USER_COLUMNS
    }
    deleted = [f"cast({present(n)} as string)" for n in DELETED_NAMES]
    return typed.selectExpr(
        *[c for c in items.columns if c != "item"],
        "coalesce(cast(v__id as string), '') as item_key",
        f"{is_deleted(*deleted)} as is_deleted",
        f"{error} as map_error",
        *[f"cast({e} as {USER_COLUMNS[c]}) as {c}" for c, e in columns.items()],
    )


def map_orgs(items: DataFrame) -> DataFrame:
    """Organisation columns of target records; organisations are never deleted."""
    typed = _read_fields(items, ORG_NAMES, ("_ouid", "parent_id"))
    error = first_message(
        ("bad__ouid", "_ouid is no integer"),
        ("_ouid is null", "Organization must contain _ouid"),
        ("bad_parent_id", "parent_id is no integer"),
    )
    return typed.selectExpr(
        *[c for c in items.columns if c != "item"],
        "coalesce(cast(v__ouid as string), '') as item_key",
        "false as is_deleted",
        f"{error} as map_error",
        *ORG_COLUMNS,
    )


def _held_elsewhere(rows: DataFrame, existing: DataFrame, key: str, unique: Sequence[str]) -> DataFrame:
    """Add ``taken_by``: the first unique column that another record of the
    existing snapshot holds."""
    taken = []
    for column in unique:
        holders = (
            existing.filter(F.col(column).isNotNull())
            .groupBy(column)
            .agg(F.min(key).alias(f"lo_{column}"), F.max(key).alias(f"hi_{column}"))
        )
        rows = lookup(rows, holders, {column: column}, "ingest_pos")
        other = (F.col(f"lo_{column}") != F.col(key)) | (F.col(f"hi_{column}") != F.col(key))
        taken.append(F.when(other, F.lit(column)))
    return rows.withColumn("taken_by", F.coalesce(*taken)).drop(
        *[f"{side}_{c}" for c in unique for side in ("lo", "hi")]
    )


def _settle(claims: DataFrame, key: str, unique: Sequence[str]) -> DataFrame:
    """One round over contested claims.

    A claim stands on a column when it is the first one left, or when the
    first one left is accepted and belongs to the same record.  It falls when
    the first one left is accepted and belongs to another record.
    """
    left = claims.filter(F.col("state") != "rejected")
    for column in unique:
        first = left.groupBy(column).agg(
            F.min_by(F.struct("ingest_pos", key, "state"), "ingest_pos").alias(f"first_{column}")
        )
        claims = lookup(claims, first, {column: column}, "ingest_pos")
    stands, falls = F.lit(True), []
    for column in unique:
        first = F.col(f"first_{column}")
        leads = first["ingest_pos"] == F.col("ingest_pos")
        settled = first["state"] == "accepted"
        mine = first[key] == F.col(key)
        stands = stands & (first.isNull() | leads | (settled & mine))
        falls.append(F.when(settled & ~mine, F.lit(column)))
    state = F.when(F.coalesce(*falls).isNotNull(), "rejected").when(stands, "accepted").otherwise("open")
    return claims.withColumns(
        {
            "taken_by": F.when(F.col("state") == "open", F.coalesce(*falls)).otherwise(F.col("taken_by")),
            "state": F.when(F.col("state") == "open", state).otherwise(F.col("state")),
        }
    ).drop(*[f"first_{c}" for c in unique])


def _pointers(claims: DataFrame, key: str, unique: Sequence[str]) -> DataFrame:
    """(ingest_pos, to, stands, column) of open claims: ``stands`` where that is known by now, and ``to`` where it depends
    on one single open claim; then the claim stands if that one falls, and falls on ``column`` if that one stands."""
    left = claims.filter(F.col("state") != "rejected")
    rows, blockers, falls, stands, alone = claims.filter(F.col("state") == "open"), [], [], F.lit(True), F.lit(True)
    for column in unique:
        first = left.groupBy(column).agg(F.min(F.struct("ingest_pos", key, "state")).alias(f"first_{column}"))
        behind = lookup(left.select("ingest_pos", column), first, {column: column}, "ingest_pos", how="inner")
        second = (
            behind.filter(F.col("ingest_pos") > F.col(f"first_{column}")["ingest_pos"])
            .groupBy(column)
            .agg(F.min("ingest_pos").alias(f"second_{column}"))
        )
        rows = lookup(lookup(rows, first, {column: column}, "ingest_pos"), second, {column: column}, "ingest_pos")
        leader = F.col(f"first_{column}")
        mine, accepted = leader[key] == F.col(key), leader["state"] == "accepted"
        free = leader.isNull() | (leader["ingest_pos"] == F.col("ingest_pos")) | (accepted & mine)
        stands = stands & free
        falls.append(F.when(~free & accepted, F.lit(column)))
        blockers.append(F.when(~free & ~mine, F.struct(leader["ingest_pos"].alias("to"), F.lit(column).alias("column"))))
        alone = alone & (free | F.coalesce(F.col(f"second_{column}") == F.col("ingest_pos"), F.lit(False)))
    found = rows.withColumns({"__by": F.array_compact(F.array(*blockers)), "__falls": F.coalesce(*falls)})
    one = alone & F.col("__falls").isNull() & (F.size(F.array_distinct(F.col("__by.to"))) == 1)
    return found.select(
        "ingest_pos",
        F.when(one, F.get("__by", F.lit(0))["to"]).alias("to"),
        F.when(F.col("__falls").isNotNull(), False).when(stands, True).alias("stands"),
        F.coalesce("__falls", F.get("__by", F.lit(0))["column"]).alias("column"),
    )


def _contract(claims: DataFrame, key: str, unique: Sequence[str]) -> DataFrame:
    """Decide chains of claims, each of which depends on the one before it, by pointer jumping: with every jump a claim
    points twice as far back, and knows whether it shares the fate of that claim or has the opposite one."""
    known = staged(_pointers(claims, key, unique), "pointers")
    pointers = known.where("to is not null").select("ingest_pos", "to", F.lit(True).alias("flip"), "column")
    while True:
        on = pointers.select(F.col("ingest_pos").alias("__at"), F.col("to").alias("__to"), F.col("flip").alias("__flip"))
        jumped = lookup(pointers, on, {"to": "__at"}, "ingest_pos").select(
            "ingest_pos", F.coalesce("__to", "to").alias("to"), (F.col("flip") != F.coalesce("__flip", F.lit(False))).alias("flip"), "column",
            F.col("__to").isNotNull().alias("moved"),
        )
        pointers = staged(jumped, "pointers")
        if pointers.filter("moved").isEmpty():
            break
    now = known.where("stands is not null").select("ingest_pos", "stands", "column")
    ends = claims.filter(F.col("state") != "open").select("ingest_pos", (F.col("state") == "accepted").alias("stands"))
    ends = ends.unionByName(now.drop("column")).select(F.col("ingest_pos").alias("__end"), F.col("stands").alias("__stands"))
    decided = lookup(pointers, ends, {"to": "__end"}, "ingest_pos", how="inner")
    decided = decided.select("ingest_pos", (F.col("__stands") != F.col("flip")).alias("stands"), "column").unionByName(now)
    decided = decided.select(F.col("ingest_pos").alias("__at"), F.col("stands").alias("__good"), F.col("column").alias("__column"))
    joined = lookup(claims, decided, {"ingest_pos": "__at"}, "ingest_pos")
    good = F.col("__good")
    return joined.withColumns(
        {
            "state": F.when(good, "accepted").when(~good, "rejected").otherwise(F.col("state")),
            "taken_by": F.when(~good, F.col("__column")).otherwise(F.col("taken_by")),
        }
    ).drop("__good", "__column")


def unique_violations(
    good: DataFrame, existing: DataFrame, key: str = "_id", unique: Sequence[str] = ("_ouid", "match_key")
) -> DataFrame:
    """(ingest_pos, taken_by) of the records that break a uniqueness rule.

    A record fails when another record holds its value: one of the existing
    snapshot, or an earlier record of this read that did not fail itself.
    Only records that share a value with another id take part in the
    sequential question; they are settled in rounds, and the lineage is cut
    after each.  A round decides the first open record of each value and what
    follows from it; two rounds are the rule. Chains, in which each record
    waits for one other, are contracted by pointer jumping, so their number of
    rounds is the logarithm of their length. Records that wait for several
    others at once are left for the next round.
    """
    narrow = _held_elsewhere(good.select("ingest_pos", key, *unique), existing, key, unique)
    narrow = staged(narrow, "claims")
    rejected = narrow.filter(F.col("taken_by").isNotNull()).select("ingest_pos", "taken_by")

    free = narrow.filter(F.col("taken_by").isNull())
    contested = free
    shared = F.lit(False)
    for column in unique:
        keys = (
            free.groupBy(column)
            .agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
            .filter("lo <> hi")
            .select(column, F.lit(True).alias(f"shared_{column}"))
        )
        contested = lookup(contested, keys, {column: column}, "ingest_pos")
        shared = shared | F.coalesce(f"shared_{column}", F.lit(False))
    claims = contested.filter(shared).select(
        "ingest_pos", key, *unique, F.lit("open").alias("state"), F.lit(None).cast("string").alias("taken_by")
    )
    claims = staged(claims, "contested")
    while True:
        claims = staged(_settle(claims, key, unique), "contested")
        if claims.filter(F.col("state") == "open").isEmpty():
            break
        claims = staged(_contract(claims, key, unique), "contested")
        if claims.filter(F.col("state") == "open").isEmpty():
            break
    return rejected.unionByName(claims.filter(F.col("state") == "rejected").select("ingest_pos", "taken_by"))


def refresh_outcome(
    mapped: DataFrame,
    existing: DataFrame,
    key: str = "_id",
    unique: Sequence[str] = ("_ouid", "match_key"),
    include_deleted: bool = False,
) -> DataFrame:
    """Classify every record read: ``outcome`` is skipped, failed, inserted or
    updated, in this order of precedence; ``message`` explains a failure.

    ``mapped`` is used several times; pass a staged table.
    """
    skipped = F.lit(False) if include_deleted else F.col("is_deleted")
    fit = mapped.filter(~skipped & F.col("map_error").isNull())
    rows = mapped.withColumn("__skipped", skipped)
    if unique:
        broken = unique_violations(fit, existing, key, unique)
        rows = rows.join(broken, "ingest_pos", "left")
    else:
        rows = rows.withColumn("taken_by", F.lit(None).cast("string"))
    message = F.coalesce(
        F.col("map_error"), F.concat(F.lit("UNIQUE constraint failed: "), F.col("taken_by"))
    )
    rows = rows.withColumn(
        "outcome", F.when(F.col("__skipped"), "skipped").when(message.isNotNull(), "failed").otherwise("good")
    ).withColumn("message", F.when(F.col("outcome") == "failed", message))

    known = existing.select(F.col(key), F.lit(True).alias("__known"))
    firsts = rows.filter(F.col("outcome") == "good").groupBy(key).agg(F.min("ingest_pos").alias("__first"))
    new_keys = lookup(firsts, known, {key: key}, "__first").filter(F.col("__known").isNull()).select(key, "__first")
    rows = lookup(rows, new_keys, {key: key}, "ingest_pos")
    kind = F.when(F.col("ingest_pos") == F.col("__first"), "inserted").otherwise("updated")
    return rows.withColumn("outcome", F.when(F.col("outcome") == "good", kind).otherwise(F.col("outcome"))).drop(
        "__skipped", "__first", "taken_by", "map_error"
    )


def diagnostics(outcome: DataFrame) -> DataFrame:
    """Report rows of a refresh: status and CACHE_ERROR diagnostics."""
    failed = dx.diagnostic(dx.CACHE, "CACHE_ERROR", None, "message", message_is_sql=True)
    return outcome.selectExpr(
        "ingest_pos as line_no",
        "item_key",
        "case outcome when 'failed' then 'FAILED' when 'skipped' then 'SKIPPED' else 'OK' end as status",
        f"{dx.emit("outcome = 'failed'", failed)} as errors",
        f"{dx.NONE} as warnings",
    )


def last_records(outcome: DataFrame, columns: Sequence[str], key: str = "_id") -> DataFrame:
    """The last surviving record of every key.

    Positions are aggregated, by hash; records of keys that occur once, the rule, are passed on as they are.
    """
    kept = outcome.filter(F.col("outcome").isin("inserted", "updated"))
    last = kept.groupBy(F.col(key).alias("__who")).agg(F.max("ingest_pos").alias("__last"), F.count(F.lit(1)).alias("__n"))
    repeated = last.where("__n > 1").select("__who", "__last")
    found = lookup(kept, repeated, {key: "__who"}, "ingest_pos")
    return found.where("__last is null or ingest_pos = __last").select(*columns)


def upsert(existing: DataFrame, incoming: DataFrame, key: str = "_id", kept: Sequence[str] = ()) -> DataFrame:
    """Full-row upsert of unique records, with ``op`` per resulting row
    (inserted, updated or kept).  Columns in ``kept`` stay as they are when
    the record exists already."""
    columns = existing.columns
    old = existing.select(*[F.col(c).alias(f"old_{c}") for c in columns], F.lit(True).alias("__old"))
    new = incoming.select(*[F.col(c).alias(f"new_{c}") for c in columns], F.lit(True).alias("__new"))
    both = old.join(new, F.col(f"old_{key}") == F.col(f"new_{key}"), "full_outer")
    fresh = F.col("__new").isNotNull()
    op = F.when(~fresh, "kept").when(F.col("__old").isNull(), "inserted").otherwise("updated")
    taken = {c: fresh & F.col("__old").isNull() if c in kept else fresh for c in columns}
    return both.select(
        *[F.when(taken[c], F.col(f"new_{c}")).otherwise(F.col(f"old_{c}")).alias(c) for c in columns],
        op.alias("op"),
    )


def differing(incoming: DataFrame, existing: DataFrame, key: str = "_id") -> DataFrame:
    """Incoming records that are new or differ from the record of their key; both sides are unique by key."""
    fields = [c for c in incoming.columns if c != key]
    old = existing.select(F.col(key).alias("__key"), F.struct(*fields).alias("__old"))
    joined = incoming.join(old, F.col(key) == F.col("__key"), "left")
    return joined.where(~F.struct(*fields).eqNullSafe(F.col("__old"))).select(*incoming.columns)


def refresh_counters(outcome: DataFrame, dataset: str) -> DataFrame:
    """inserted / updated / failed / skipped and the number of pages read."""
    kinds = ("inserted", "updated", "failed", "skipped")
    return outcome.agg(
        *[F.count_if(F.col("outcome") == k).alias(k) for k in kinds],
        F.coalesce(F.max("page"), F.lit(0)).cast("bigint").alias("pages"),
    ).select(F.lit(dataset).alias("dataset"), *kinds, "pages")


def refresh_totals(counters: DataFrame) -> DataFrame:
    return counters.agg(
        *[F.sum(k).cast("bigint").alias(k) for k in ("inserted", "updated", "failed", "skipped")]
    )


def refresh_meta(counters: DataFrame, count_total: Column, run_id: str, source: str | None = None) -> DataFrame:
    """Key / value metadata of a refresh, one row per entry."""
    items = F.col("inserted") + F.col("updated") + F.col("failed") + F.col("skipped")
    entries = [
        ("last_refresh_run_id", F.lit(run_id)),
        ("last_refresh_pages", F.col("pages").cast("string")),
        ("last_refresh_items", items.cast("string")),
        ("count_total", count_total.cast("string")),
    ]
    if source:
        entries.append(("source_base", F.lit(source)))
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in entries])
    return counters.select("dataset", F.inline(pairs))


def stale_rows(existing: DataFrame, incoming: DataFrame, key: str = "_id") -> DataFrame:
    """Snapshot records that the last full read did not bring."""
    return existing.join(incoming.select(key).distinct(), key, "left_anti")
