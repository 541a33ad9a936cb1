"""Enrichment: match key, manager, ids, codes and secret defaults.

Each lookup works on the few columns it needs and answers with small integers
per row.  All answers meet in one aggregation and one join back, so the wide
row is shuffled once however many lookups there are.  Most answers are rare
events (an id or a code that is taken).

A row is known by the source it came from and its number there (``ROW_KEY``);
a feed of one source may leave the source out.  Every join and every drawn
value depends on both, so files that number their records alike neither
exchange answers nor draw the same ids.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedplan.functions import diagnostics as dx
from feedplan.functions.text import strict_int
from feedplan.operators import codes
from feedplan.operators.lookup import drop_held, keep_held, lookup
from feedplan.operators.matching import active, match_key
from feedplan.sources.staging import staged

ROW_KEY = ("source_id", "line_no")


def row_key(rows: DataFrame) -> list[str]:
    """Columns that tell the rows of a feed apart."""
    return [c for c in ROW_KEY if c in rows.columns]


def with_source(rows: DataFrame) -> DataFrame:
    """Rows of a single source have the empty one."""
    return rows if "source_id" in rows.columns else rows.withColumn("source_id", F.lit(""))


def require_unique(rows: DataFrame) -> DataFrame:
    """Fail when two rows share source and number: they could not be told apart."""
    keys = row_key(rows)
    twice = rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").limit(1)
    if not twice.isEmpty():
        raise ValueError(f"several rows of the feed share {' and '.join(keys)}")
    return rows


@dataclass(frozen=True)
class EnrichSpec:
    """What a dataset's enrichment needs to know.

    ``manager_mode`` is ``match_key`` (the reference text is looked up as a
    business key), ``ouid`` (it is the number of the manager) or ``none`` (no
    lookup is configured, which is reported).  ``code_width`` is the number of
    hex digits of a drawn code; None lets it follow the size of the feed.
    ``code_draws`` is ``hash`` (a code is a digest of the row and the attempt, and
    collisions are settled) or ``permutation`` (``operators.codes``: no collisions,
    no attempts, every row is served while a code is free).
    """

    dataset: str
    run_id: str
    key_parts: Sequence[str]
    code_column: str = "usr_org_tab_num"
    code_prefix: str = "TAB-"
    code_width: int | None = None
    code_draws: str = "hash"
    attempts: int = 3
    manager_mode: str = "match_key"
    secret: str = "password"


#: Hex digits of a drawn code at least.
LEAST_WIDTH = 8


def sized(spec: EnrichSpec, rows: DataFrame) -> EnrichSpec:
    """The spec with a code width that leaves draws of this many rows mostly apart: codes are as many as the
    square of the rows."""
    if spec.code_width is not None:
        return spec
    if spec.code_draws == "permutation":
        return replace(spec, code_width=codes.width_for(rows.count(), LEAST_WIDTH))
    digits = math.ceil(2 * math.log(max(rows.count(), 1), 16))
    return replace(spec, code_width=max(LEAST_WIDTH, digits))


def _draw(spec: EnrichSpec, purpose: str, attempt: int | str, keys: Sequence[str]) -> str:
    """Deterministic hex text of a row (SQL): a retried task draws the same.  The empty source adds nothing."""
    fixed = f"{spec.run_id}|{spec.dataset}|{purpose}".replace("'", "\\'")
    parts = ["nullif(source_id, '')" if k == "source_id" else k for k in keys]
    return f"sha2(concat_ws('|', '{fixed}', {', '.join(parts)}, {attempt}), 256)"


def new_id(spec: EnrichSpec, attempt: int | str, keys: Sequence[str] = ("line_no",)) -> str:
    """Candidate id (SQL) in the usual 8-4-4-4-12 form; ``attempt`` may be a column."""
    cuts = "([0-9a-f]{8})([0-9a-f]{4})([0-9a-f]{4})([0-9a-f]{4})([0-9a-f]{12})"
    return f"regexp_replace(left({_draw(spec, 'id', attempt, keys)}, 32), '{cuts}', '$1-$2-$3-$4-$5')"


def new_code(spec: EnrichSpec, attempt: int | str, keys: Sequence[str] = ("line_no",)) -> str:
    """Candidate code (SQL): prefix and ``code_width`` hex digits."""
    width = spec.code_width or LEAST_WIDTH
    return f"concat('{spec.code_prefix}', left({_draw(spec, 'code', attempt, keys)}, {width}))"


def picked_code(spec: EnrichSpec, keys: Sequence[str] = ("line_no",)) -> str:
    """The code (SQL) that ``code_pick`` stands for."""
    if spec.code_draws == "permutation":
        return f"concat('{spec.code_prefix}', lpad(lower(hex(code_pick - 1)), {spec.code_width or LEAST_WIDTH}, '0'))"
    return new_code(spec, "code_pick", keys)


def add_match_key(rows: DataFrame, spec: EnrichSpec) -> DataFrame:
    """Key of clean normalised rows; NULL where a part is missing."""
    key = match_key(spec.key_parts, normalized=True)
    return rows.withColumn("match_key", F.expr(f"if({dx.CLEAN}, {key}, null)"))


# Manager states; 0 is no error.
_OK, _MISSING, _CONFLICT, _NOT_FOUND, _NO_OUID = 0, 1, 2, 3, 4


def resolve_managers(rows: DataFrame, target: DataFrame, spec: EnrichSpec) -> DataFrame:
    """(row key, manager_ouid, manager_state) of the rows that name a manager."""
    keys = row_key(rows)
    asked = rows.where("size(errors) = 0 and manager_key is not null")
    if spec.manager_mode == "none":
        return asked.selectExpr(*keys, "cast(null as bigint) as manager_ouid", f"{_MISSING} as manager_state")
    if spec.manager_mode == "ouid":
        key, asked = "_ouid", asked.selectExpr(*keys, f"{strict_int('manager_key')} as manager_key")
    else:
        key, asked = "match_key", asked.select(*keys, "manager_key")
    # two primitive aggregates: hash aggregation, collapsed before the shuffle
    index = (
        active(target)
        .where(f"{key} is not null")
        .selectExpr(f"{key} as __who", "_ouid")
        .groupBy("__who")
        .agg(F.expr("count(*) as n"), F.expr("min(_ouid) as manager_ouid"))
    )
    state = (
        f"case when n > 1 then {_CONFLICT} when n is null then {_NOT_FOUND} "
        f"when manager_ouid is null then {_NO_OUID} else {_OK} end as manager_state"
    )
    return lookup(asked, index, {"manager_key": "__who"}, "line_no").selectExpr(*keys, "manager_ouid", state)


def first_free(
    need: DataFrame, target: DataFrame, key: str, candidate: str, attempts: int, owner: str | None = None
) -> DataFrame:
    """(row key, pick): first attempt whose candidate is free, 0 without one.

    ``need`` has the row key and the first attempt ``start``.  A candidate is
    free when nobody in the target holds it.  With ``owner`` (a column of both
    sides) a candidate held by the row's own record is free too, so that a
    repeated run keeps what an earlier run has drawn, and no two rows get the
    same one: attempt by attempt, a candidate that several unserved rows draw
    goes to the first of them, and a served row asks no more.
    """
    keys = row_key(need)
    kept = keys + ([owner] if owner else [])
    # one attempt more than allowed stands for failure: it draws nothing, is
    # always free, and spares a second pass over ``need``
    last = attempts + 1
    tries = need.selectExpr(*kept, f"explode(sequence(start, greatest(start, {last}))) as attempt")
    tries = tries.withColumn("__draw", F.expr(f"if(attempt < {last}, {candidate}, null)"))
    if owner is None:
        free = drop_held(tries, target, {"__draw": key}, "line_no")
    else:
        holders = (
            target.where(f"{key} is not null")
            .groupBy(key)
            .agg(F.expr(f"min({owner}) as __lo"), F.expr(f"max({owner}) as __hi"))
        )
        probed = lookup(tries, holders, {"__draw": key}, "line_no")
        unclaimed = probed.where(f"__lo is null or (__lo = {owner} and __hi = {owner})")
        free = _shared_out(staged(unclaimed.select(*keys, "attempt", "__draw"), "draws"), keys, last)
    return free.groupBy(*keys).agg(F.expr(f"if(min(attempt) < {last}, min(attempt), 0) as pick"))


def _shared_out(free: DataFrame, keys: Sequence[str], last: int) -> DataFrame:
    """(row key, attempt) of the rows that are served, in as many rounds as there are attempts; and the attempt
    that stands for failure for every row."""
    served = None
    for attempt in range(1, last):
        asking = free.where(F.col("attempt") == attempt)
        if served is not None:
            asking = asking.join(served.select(*keys), list(keys), "left_anti").join(served.select("__draw"), "__draw", "left_anti")
        won = asking.groupBy("__draw").agg(F.min(F.struct(*keys)).alias("row"))
        won = won.select("row.*", F.lit(attempt).alias("attempt"), "__draw")
        served = won if served is None else served.unionByName(won)
    failed = free.where(F.col("attempt") == last).select(*keys, "attempt")
    return failed if served is None else served.select(*keys, "attempt").unionByName(failed)


def allocate_ids(rows: DataFrame, target: DataFrame, spec: EnrichSpec, key: str = "_id") -> DataFrame:
    """(row key, id_pick) of the rows whose first candidate id is taken.

    ``id_pick`` is the attempt to use, 0 when all attempts are taken.  Rows
    that are not in the answer use their given id or attempt 1.
    """
    keys = row_key(rows)
    first = rows.where("size(errors) = 0").selectExpr(*keys, f"{first_id(spec, rows)} as __draw")
    taken = keep_held(first, target, {"__draw": key}, "line_no").selectExpr(*keys, "2 as start")
    return first_free(taken, target, key, new_id(spec, "attempt", keys), spec.attempts).withColumnRenamed("pick", "id_pick")


def first_id(spec: EnrichSpec, rows: DataFrame) -> str:
    """The given id, else the first generated one (SQL)."""
    generated = new_id(spec, 1, row_key(rows))
    return f"coalesce(nullif(resource_id, ''), {generated})" if "resource_id" in rows.columns else generated


def allocate_codes(rows: DataFrame, target: DataFrame, spec: EnrichSpec) -> DataFrame:
    """(row key, code_pick) of the rows that cannot keep their own code.

    A given code stays unless another key holds it.  A replacement is the
    first generated code that no other key holds in the target and that no
    row served before it got; 0 means that none is left.  ``picked_code`` is the
    code of a pick.
    """
    keys = row_key(rows)
    code = spec.code_column
    narrow = rows.where("size(errors) = 0").select(*keys, "match_key", code)
    not_mine = drop_held(
        narrow.where(f"{code} is not null"), target, {code: code, "match_key": "match_key"}, "line_no"
    )
    taken = keep_held(not_mine, target, {code: code}, "line_no").selectExpr(*keys, "match_key", "2 as start")
    need = taken.union(narrow.where(f"{code} is null").selectExpr(*keys, "match_key", "1 as start"))
    if spec.code_draws == "permutation":
        seed = f"{spec.run_id}|{spec.dataset}|code"
        width = spec.code_width or LEAST_WIDTH
        picks = codes.permuted_codes(need, target, code, "match_key", spec.code_prefix, width, seed, keys)
    else:
        picks = first_free(need, target, code, new_code(spec, "attempt", keys), spec.attempts, owner="match_key")
    return picks.withColumnRenamed("pick", "code_pick")


_ANSWERS = {"manager_ouid": "bigint", "manager_state": "int", "id_pick": "int", "code_pick": "bigint"}


def _collect(parts: Sequence[DataFrame]) -> DataFrame:
    """All answers of a row in one row."""
    keys = row_key(parts[0])
    union = None
    for part in parts:
        columns = [f"cast({c if c in part.columns else 'null'} as {t}) as {c}" for c, t in _ANSWERS.items()]
        aligned = part.selectExpr(*keys, *columns)
        union = aligned if union is None else union.union(aligned)
    return union.groupBy(*keys).agg(*[F.max(c).alias(c) for c in _ANSWERS])


def enrich(rows: DataFrame, target: DataFrame, spec: EnrichSpec) -> DataFrame:
    """Run all enrichment rules on the clean rows.

    Adds ``match_key``, ``manager_id``, ``resource_id``, ``code_generated`` and
    ``secret_generated``, replaces the code column, appends diagnostics.
    Rules do not stop each other; only earlier stages do.  ``rows`` is read by
    every rule: pass a staged table.
    """
    spec, keys = sized(spec, rows), row_key(rows)
    keyed = add_match_key(rows, spec)
    answers = _collect(
        [
            resolve_managers(keyed, target, spec),
            allocate_ids(keyed, target, spec),
            allocate_codes(keyed, target, spec),
        ]
    )
    code = spec.code_column
    # Condition, code, field and message of each rule, in order.
    rules = [
        ("match_key is null", "MATCH_KEY_MISSING", "matchKey", "match_key cannot be built"),
        (f"manager_state = {_MISSING}", "MANAGER_LOOKUP_MISSING", "managerId", "identity lookup is not configured"),
        (f"manager_state = {_CONFLICT}", "MANAGER_CONFLICT", "managerId", "multiple managers found for match_key"),
        (f"manager_state = {_NOT_FOUND}", "MANAGER_NOT_FOUND", "managerId", "manager not found in cache"),
        (f"manager_state = {_NO_OUID}", "MANAGER_OUID_MISSING", "managerId", "manager has no _ouid"),
        ("id_pick = 0", "RESOURCE_ID_CONFLICT", "resource_id", "unable to generate unique resource_id"),
        ("code_pick = 0", "USR_ORG_TAB_CONFLICT", "usrOrgTabNum", "unable to generate unique usr_org_tab_num"),
    ]
    found = [
        dx.emit(f"size(errors) = 0 and {when}", dx.diagnostic(dx.ENRICH, error, field, message))
        for when, error, field, message in rules
    ]
    replaced = (code, "errors", "resource_id", "manager_id", "match_key")
    resource_id = f"case when id_pick is null then {first_id(spec, rows)} when id_pick > 0 then {new_id(spec, 'id_pick', keys)} end"
    return keyed.join(answers, keys, "left").selectExpr(
        *[c for c in keyed.columns if c not in replaced],
        "match_key",
        f"if(manager_state = {_OK}, manager_ouid, null) as manager_id",
        f"if({dx.CLEAN}, {resource_id}, null) as resource_id",
        f"case when code_pick is null then {code} when code_pick > 0 then {picked_code(spec, keys)} end as {code}",
        "coalesce(code_pick > 0, false) as code_generated",
        f"{dx.CLEAN} and coalesce(secrets['{spec.secret}'], '') = '' as secret_generated",
        f"{dx.gather(['errors', *found])} as errors",
    )


def survivors(rows: DataFrame) -> DataFrame:
    """Rows that go on to validation; ``dropped_rows`` lists the others."""
    return rows.where("size(errors) = 0")
