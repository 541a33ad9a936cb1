"""Create / update / skip / conflict decisions and the plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedplan.functions import diagnostics as dx
from feedplan.functions.text import quoted
from feedplan.operators.diff import FieldDiff, change_set, diff_fields
from feedplan.operators.enrich import row_key

# Kinds of decisions.  Rows with errors are ``invalid``.
CREATE, UPDATE, SKIP, CONFLICT, INVALID = "create", "update", "skip", "conflict", "invalid"


def decide(matched: DataFrame, fields: Sequence[FieldDiff]) -> DataFrame:
    """Add ``diff``, ``decision``, ``reason``, ``status`` and the final
    ``resource_id``.

    Expects the columns of ``match_target`` and ``enrich``.  A conflict gets
    its diagnostic here.
    """
    compared = matched.withColumn("diff", F.expr(diff_fields("candidate", fields)))
    decision = (
        f"case when {dx.FAILED} then '{INVALID}' when match_status = 'conflict' then '{CONFLICT}' "
        f"when match_status = 'not_found' then '{CREATE}' when size(diff) = 0 then '{SKIP}' else '{UPDATE}' end"
    )
    decided = compared.withColumn("decision", F.expr(decision))
    conflict = dx.diagnostic(dx.PLAN, "MATCH_CONFLICT", "matchKey", "multiple candidates found")
    columns = {
        "resource_id": "case when decision = 'create' then resource_id "
        "when decision in ('update', 'skip') then candidate._id end",
        "errors": f"if(decision = 'conflict', array({conflict}), errors)",
    }
    return decided.selectExpr(
        *[f"{columns.get(c, c)} as {c}" for c in decided.columns],
        "map('conflict', 'MATCH_CONFLICT', 'skip', 'NO_CHANGES')[decision] as reason",
        "case when decision in ('create', 'update') then 'OK' when decision = 'skip' then 'SKIPPED' "
        "else 'FAILED' end as status",
    )


def desired_state(columns: Sequence[str]) -> str:
    """The canonical row without secrets and without the id (SQL text)."""
    return f"struct({', '.join(columns)})"


def plan_items(decided: DataFrame, desired: Sequence[str], secrets: Sequence[str] = ("password",)) -> DataFrame:
    """The create and update rows as plan items.

    An item without an id would be a fatal mistake of the planner, so it fails
    the job.
    """
    names = ", ".join(quoted(s) for s in secrets)
    source = "if(source_id = '', '', concat(source_id, ':')), " if "source_id" in decided.columns else ""
    return decided.where("decision in ('create', 'update')").selectExpr(
        f"concat({source}'line:', line_no) as row_id",
        *row_key(decided),
        "decision as op",
        "coalesce(nullif(resource_id, ''), raise_error('decision without resource_id')) as resource_id",
        f"{desired_state(desired)} as desired_state",
        f"{change_set('diff')} as changes",
        "map('match_key', match_key) as source_ref",
        f"if(decision = 'create', array({names}), cast(array() as array<string>)) as secret_fields",
    )


def plan_summary(decided: DataFrame) -> DataFrame:
    """All counters of a plan in one pass."""
    kind = F.col("decision")
    return decided.agg(
        F.count("*").alias("rows_total"),
        F.count_if(kind.isin(CREATE, UPDATE, SKIP)).alias("valid_rows"),
        F.count_if(kind.isin(INVALID, CONFLICT)).alias("failed_rows"),
        F.count_if(kind == CREATE).alias("planned_create"),
        F.count_if(kind == UPDATE).alias("planned_update"),
        F.count_if(kind == SKIP).alias("skipped"),
    )
