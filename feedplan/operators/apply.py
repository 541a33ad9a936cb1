"""Applying a plan: requests, outcomes, retries and counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedplan.functions import diagnostics as dx
from feedplan.functions import outcomes as oc
from feedplan.functions.masking import mask_json_text
from feedplan.functions.text import bad_flag, lenient_bool, strict_int
from feedplan.operators.enrich import EnrichSpec, first_free, new_id, row_key
from feedplan.operators.lookup import keep_held
from feedplan.operators.snapshot import upsert
from feedplan.operators.vault import missing_secret

# Payload field -> desired-state field, in the order of the
# target contract.  ``avatarId`` is always null.
PAYLOAD = {
    "mail": "email",
    "lastName": "last_name",
    "firstName": "first_name",
    "middleName": "middle_name",
    "isLogonDisabled": "is_logon_disable",
    "userName": "user_name",
    "phone": "phone",
    "password": "password",
    "personnelNumber": "personnel_number",
    "managerId": "manager_id",
    "organization_id": "organization_id",
    "position": "position",
    "avatarId": None,
    "usrOrgTabNum": "usr_org_tab_num",
}
# Fields that must be present, in the order they are reported.
PAYLOAD_REQUIRED = (
    "email", "last_name", "first_name", "middle_name", "is_logon_disable", "user_name",
    "phone", "password", "personnel_number", "organization_id", "position", "usr_org_tab_num",
)


def payload_error(source: dict[str, str], required: Sequence[str] = PAYLOAD_REQUIRED) -> str:
    """Why no payload can be built, else NULL (SQL text)."""
    gaps = [f"if(coalesce(cast({source[f]} as string), '') = '', '{f}', null)" for f in required]
    missing = f"nullif(concat_ws(', ', {', '.join(gaps)}), '')"
    checks = [
        f"concat('Missing required fields for payload: ', {missing})",
        f"if({bad_flag(f"cast({source['is_logon_disable']} as string)")}, "
        "'Invalid boolean value for isLogonDisabled', null)",
    ]
    for f in ("manager_id", "organization_id"):
        text = f"cast({source[f]} as string)"
        checks.append(f"if({text} <> '' and {strict_int(text)} is null, '{f} is no integer', null)")
    return f"coalesce({', '.join(checks)})"


def upsert_payload(source: dict[str, str]) -> str:
    """The 14 fields of the target contract as a struct (SQL text)."""
    fields = []
    for name, attr in PAYLOAD.items():
        if attr is None:
            value = "cast(null as string)"
        elif attr == "is_logon_disable":
            value = lenient_bool(f"cast({source[attr]} as string)")
        elif attr in ("manager_id", "organization_id"):
            value = strict_int(f"cast({source[attr]} as string)")
        else:
            value = source[attr]
        fields.append(f"'{name}', {value}")
    return f"named_struct({', '.join(fields)})"


def payload_source(password: str = "cast(null as string)") -> dict[str, str]:
    """Payload inputs out of a plan item."""
    fields = {a: f"desired_state.{a}" for a in PAYLOAD.values() if a}
    return {**fields, "password": password}


def request_rows(items: DataFrame, path_prefix: str = "/managed/user", strict: bool = True) -> DataFrame:
    """One request per plan item with its preparation error.

    Expects ``secret_password`` (see ``attach_secrets``).  In strict mode an
    update needs a password as well, which no plan provides; otherwise it is
    required for creates only.
    """
    source = payload_source("secret_password")
    error = payload_error(source)
    if not strict:
        no_password = tuple(f for f in PAYLOAD_REQUIRED if f != "password")
        error = f"if(op = 'update', {payload_error(source, no_password)}, {error})"
    checked = items.selectExpr("*", f"{missing_secret(['password'])} as __secret", f"{error} as __error")
    coded = checked.selectExpr(
        "*",
        "case when coalesce(resource_id, '') = '' then 'RESOURCE_ID_MISSING' "
        "when __secret is not null then 'SECRET_REQUIRED' "
        "when __error is not null then 'UNEXPECTED_ERROR' end as error_code",
    )
    return coded.selectExpr(
        *row_key(items),
        "row_id",
        "op",
        "resource_id",
        "'PUT' as method",
        f"concat('{path_prefix.rstrip('/')}/', resource_id) as path",
        "map('_prettyPrint', 'true', 'decrypt', 'false') as query",
        f"if(error_code is null, {upsert_payload(source)}, null) as payload",
        "error_code",
        "if(error_code = 'SECRET_REQUIRED', __secret, null) as error_field",
        "if(error_code = 'UNEXPECTED_ERROR', __error, null) as error_message",
    )


#: Characters of a masked body that an outcome keeps.
SNIPPET = 200


def classify_outcomes(log: DataFrame, expected: tuple[int, ...] = (200, 201), snippet_chars: int = SNIPPET) -> DataFrame:
    """Normalise a response log (``status``, ``body``): error code, reason,
    message, and the first ``snippet_chars`` characters of the masked body."""
    ok = oc.is_expected(F.col("status"), expected)
    masked = log.withColumn("__masked", mask_json_text(F.col("body")))
    snippet = F.substring("__masked", 1, snippet_chars)
    return masked.withColumns(
        {
            "ok": ok,
            "error_code": F.when(~ok, oc.error_code(F.col("status"))),
            "error_reason": F.when(~ok, oc.failure_reason(F.col("body"))),
            "error_message": F.when(~ok, F.concat(F.lit("HTTP "), F.col("status"))),
            "retryable": oc.is_retryable(F.col("status")),
            "body_snippet": F.when(~ok, F.nullif(snippet, F.lit(""))),
        }
    ).drop("__masked")


def apply_outcome(requests: DataFrame, responses: DataFrame, dry_run: bool = False) -> DataFrame:
    """Outcome of every request: created, updated or failed with a code.

    ``responses`` has one row per request.  In a dry run every item with an id
    succeeds and nothing is sent.
    """
    keys = row_key(requests)
    done = F.when(F.col("op") == "create", "created").when(F.col("op") == "update", "updated")
    no_id = F.col("error_code") == "RESOURCE_ID_MISSING"
    if dry_run:
        code = F.when(no_id, F.col("error_code"))
        rows = requests.withColumn("code", code)
    else:
        answers = classify_outcomes(responses).select(
            *keys, F.col("ok").alias("__ok"), F.col("error_code").alias("__code")
        )
        joined = requests.join(answers, keys, "left")
        answered = F.when(F.coalesce("__ok", F.lit(False)), F.lit(None)).otherwise(
            F.coalesce("__code", F.lit("NETWORK_ERROR"))
        )
        rows = joined.withColumn("code", F.coalesce("error_code", answered))
    return rows.select(
        *keys, "op", "resource_id", F.when(F.col("code").isNull(), done).otherwise("failed").alias("outcome"), "code"
    )


def table_outcome(requests: DataFrame, refused: DataFrame, dry_run: bool = False) -> DataFrame:
    """Outcome of an apply to a table: what the request lacks, or ``CONFLICT``
    for the rows in ``refused``, whose id the table holds already."""
    keys = row_key(requests)
    done = F.when(F.col("op") == "create", "created").when(F.col("op") == "update", "updated")
    if dry_run:
        rows = requests.withColumn("code", F.when(F.col("error_code") == "RESOURCE_ID_MISSING", F.col("error_code")))
    else:
        marked = requests.join(refused.select(*keys, F.lit("CONFLICT").alias("__refused")), keys, "left")
        rows = marked.withColumn("code", F.coalesce("error_code", "__refused"))
    return rows.select(*keys, "op", "resource_id", F.when(F.col("code").isNull(), done).otherwise("failed").alias("outcome"), "code")


def apply_report_rows(outcome: DataFrame) -> DataFrame:
    """Report rows of an apply run: status, an APPLY diagnostic for each
    failure, and the operation and id as context."""
    failed = dx.diagnostic(dx.APPLY, "x", None, "concat(op, ' failed: ', code)", message_is_sql=True).replace("'x'", "code")
    return outcome.selectExpr(
        *row_key(outcome),
        "if(code is null, 'OK', 'FAILED') as status",
        f"{dx.emit('code is not null', failed)} as errors",
        f"{dx.NONE} as warnings",
        "op",
        "map('op', op, 'resource_id', resource_id) as context",
    )


def first_actions(items: DataFrame, max_actions: int | None) -> DataFrame:
    """Only the first items of the plan (a top-n by source and line)."""
    return items if max_actions is None else items.orderBy(*row_key(items)).limit(max_actions)


def stop_at_first_error(outcome: DataFrame) -> DataFrame:
    """Outcomes up to and including the first failure, in the order of sources and lines."""
    place = F.struct(*row_key(outcome))
    first = outcome.filter(F.col("outcome") == "failed").agg(F.min(place))
    return outcome.filter(F.coalesce(place <= first.scalar(), F.lit(True)))


def retry_ids(items: DataFrame, target: DataFrame, spec: EnrichSpec, retries: int = 3, key: str = "_id") -> DataFrame:
    """Give creates whose id is taken in the target a new id.

    Adds ``id_attempt``: 0 when the planned id is free, n for the n-th new id,
    NULL when all retries are used up (the create fails with CONFLICT).
    """
    keys = row_key(items)
    planned = items.where("op = 'create'").selectExpr(*keys, "resource_id as __draw")
    taken = keep_held(planned, target, {"__draw": key}, "line_no").selectExpr(*keys, "1 as start")
    # ids of retries do not repeat those of the allocation
    picks = first_free(taken, target, key, new_id(spec, "(attempt + 1000)", keys), retries)
    joined = items.join(picks, keys, "left")
    renewed = new_id(spec, "(pick + 1000)", keys)
    return joined.withColumns(
        {
            "id_attempt": F.expr("case when pick is null then 0 when pick > 0 then pick end"),
            "resource_id": F.expr(f"if(pick > 0, {renewed}, resource_id)"),
        }
    ).drop("pick")


def target_rows(items: DataFrame) -> DataFrame:
    """Snapshot rows that the items of a plan lead to."""
    s = F.col("desired_state")
    return items.select(
        F.col("resource_id").alias("_id"),
        F.lit(None).cast("bigint").alias("_ouid"),
        s["personnel_number"].alias("personnel_number"),
        s["last_name"].alias("last_name"),
        s["first_name"].alias("first_name"),
        s["middle_name"].alias("middle_name"),
        F.col("source_ref")["match_key"].alias("match_key"),
        s["email"].alias("mail"),
        s["user_name"].alias("user_name"),
        s["phone"].alias("phone"),
        s["usr_org_tab_num"].alias("usr_org_tab_num"),
        s["organization_id"].alias("organization_id"),
        F.lit(None).cast("string").alias("account_status"),
        F.lit(None).cast("string").alias("deletion_date"),
        F.lit(None).cast("string").alias("_rev"),
        s["manager_id"].alias("manager_ouid"),
        s["is_logon_disable"].cast("int").alias("is_logon_disabled"),
        s["position"].alias("position"),
        F.lit(None).cast("string").alias("updated_at"),
        *row_key(items),
    )


# Columns that the target system fills itself; an update leaves them alone.
_OWNED = ("_ouid", "account_status", "deletion_date", "_rev", "updated_at")


def apply_to_target(items: DataFrame, target: DataFrame) -> DataFrame:
    """Merge a plan into a target table; ``op`` tells what became of each row.

    Several items for one record are merged to the last one.  New records have
    no ``_ouid`` until the target numbers them and the next refresh reads it.
    """
    return upsert(target, _last_rows(items, target), "_id", kept=_OWNED)


def changed_records(items: DataFrame, target: DataFrame) -> DataFrame:
    """The records that a plan inserts or updates in a target table, and no others: the table is read, but not moved."""
    incoming = _last_rows(items, target)
    touched = target.join(incoming.select("_id"), "_id", "left_semi")
    return upsert(touched, incoming, "_id", kept=_OWNED).drop("op")


def _last_rows(items: DataFrame, target: DataFrame) -> DataFrame:
    rows = target_rows(items)
    keys = row_key(rows)
    # the place of the last item is found on narrow rows; its record is joined back
    place = F.max(F.struct(*keys)) if len(keys) > 1 else F.max(keys[0])
    last = rows.select("_id", *keys).groupBy("_id").agg(place.alias("__last"))
    last = last.select("_id", "__last.*") if len(keys) > 1 else last.withColumnRenamed("__last", keys[0])
    return rows.join(last, ["_id", *keys], "left_semi").select(*target.columns)


def apply_counters(outcome: DataFrame, skipped: Column) -> DataFrame:
    """Counters of a run and its exit status: 2 after an authorisation
    failure, 1 after any other failure, else 0."""
    failed = F.col("outcome") == "failed"
    denied = failed & F.col("code").isin("UNAUTHORIZED", "FORBIDDEN")
    counts = outcome.agg(
        F.count_if(F.col("outcome") == "created").alias("created"),
        F.count_if(F.col("outcome") == "updated").alias("updated"),
        F.count_if(failed).alias("failed"),
        F.count_if(denied).alias("__denied"),
    )
    status = F.when(F.col("__denied") > 0, 2).when(F.col("failed") > 0, 1).otherwise(0)
    return counts.select("created", "updated", skipped.alias("skipped"), "failed", status.alias("exit_status"))
