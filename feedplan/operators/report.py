"""Run reports: counters, histograms and bounded item samples.

Every counter set is one aggregation.  Inputs are rows with ``status``
(OK / FAILED / SKIPPED), ``errors`` and ``warnings``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedplan.functions import diagnostics as dx
from feedplan.operators.enrich import row_key
from feedplan.operators.lookup import salts_of

#: Rows of a sample at most: up to here every task cuts its groups before the shuffle.
MOST_SAMPLES = 1000


def run_status(errors_total: Column, rows_passed: Column) -> Column:
    return (
        F.when(errors_total == 0, "SUCCESS").when(rows_passed > 0, "PARTIAL").otherwise("FAILED")
    )


def report_summary(rows: DataFrame) -> DataFrame:
    """Row counters, diagnostic totals and the status of the run."""
    totals = rows.agg(
        F.count("*").alias("rows_total"),
        F.count_if(F.col("status") == "OK").alias("rows_passed"),
        F.count_if(F.col("status") == "FAILED").alias("rows_blocked"),
        F.count_if(F.size("warnings") > 0).alias("rows_with_warnings"),
        F.coalesce(F.sum(F.size("errors")), F.lit(0)).cast("bigint").alias("errors_total"),
        F.coalesce(F.sum(F.size("warnings")), F.lit(0)).cast("bigint").alias("warnings_total"),
    )
    return totals.withColumn("status", run_status(F.col("errors_total"), F.col("rows_passed")))


def diagnostics_by_stage(rows: DataFrame) -> DataFrame:
    """Errors and warnings per stage."""
    both = F.array(
        F.struct(F.lit(1).alias("is_error"), F.col("errors")["stage"].alias("stages")),
        F.struct(F.lit(0).alias("is_error"), F.col("warnings")["stage"].alias("stages")),
    )
    flat = rows.select(F.inline(both)).select("is_error", F.explode("stages").alias("stage"))
    return flat.groupBy("stage").agg(
        F.sum("is_error").cast("bigint").alias("errors_total"),
        F.sum(1 - F.col("is_error")).cast("bigint").alias("warnings_total"),
    )


def error_histogram(rows: DataFrame) -> DataFrame:
    return rows.select(F.explode(F.col("errors")["code"]).alias("code")).groupBy("code").agg(
        F.count("*").alias("n")
    )


def ops_counters(events: DataFrame) -> DataFrame:
    """Sums of ok / failed / count per operation."""
    return events.groupBy("op").agg(*[F.sum(c).cast("bigint").alias(c) for c in ("ok", "failed", "count")])


def stage_report(rows: DataFrame) -> DataFrame:
    """Counters of the mapping, normalize and enrich stages."""
    generated = F.col("secret_generated").cast("int") if "secret_generated" in rows.columns else F.lit(0)
    n_secrets = F.size("secrets") + generated
    return rows.agg(
        F.count("*").alias("rows_total"),
        F.count_if(F.expr(dx.CLEAN)).alias("ok"),
        F.count_if(F.expr(dx.FAILED)).alias("failed"),
        F.count_if(F.size("warnings") > 0).alias("warnings_rows"),
        F.count_if(n_secrets > 0).alias("vault_candidates_rows"),
        F.sum(n_secrets).cast("bigint").alias("vault_candidates_fields_total"),
    )


def validate_report(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count("*").alias("rows_total"),
        F.count_if(F.expr(dx.CLEAN)).alias("valid_rows"),
        F.count_if(F.expr(dx.FAILED)).alias("failed_rows"),
        F.count_if(F.size("warnings") > 0).alias("warnings_rows"),
    )


def storable(rows: DataFrame, include_skipped: bool = False, include_ok: bool = False) -> DataFrame:
    """Failed rows always, skipped and passed rows on request."""
    kinds = ["FAILED"] + ["SKIPPED"] * include_skipped + ["OK"] * include_ok
    return rows.filter(F.col("status").isin(*kinds))


def report_items(rows: DataFrame, limit: int, include_skipped: bool = False, include_ok: bool = False) -> DataFrame:
    """The first ``limit`` storable rows in feed order, by source and line (a top-n, no full sort)."""
    return storable(rows, include_skipped, include_ok).orderBy(*row_key(rows)).limit(limit)


def items_truncated(rows: DataFrame, limit: int, include_skipped: bool = False, include_ok: bool = False) -> DataFrame:
    """Whether a passed or failed item was cut; cut skipped items do not count."""
    counted = F.count_if(F.col("status") != "SKIPPED").alias("n")
    kept = report_items(rows, limit, include_skipped, include_ok).agg(counted)
    whole = storable(rows, include_skipped, include_ok).agg(counted)
    return whole.select((F.col("n") > kept.scalar()).alias("items_truncated"))


def diagnostic_samples(rows: DataFrame, limit: int, column: str = "errors") -> DataFrame:
    """The first ``limit`` rows (1,000 at most) for each stage and code of their diagnostics, by source and line:
    (stage, code, place, row key, status, n_rows, truncated).

    A row counts once for a stage and code, however often it has them. Samples are merged up a tree: every task keeps
    its first rows before anything is shuffled, then parts of a group theirs, then the groups, so that a code that most
    rows have is no load for one task.
    """
    if not 1 <= limit <= MOST_SAMPLES:
        raise ValueError(f"a sample has 1 to {MOST_SAMPLES} rows")
    keys = row_key(rows)
    kinds = F.array_distinct(F.transform(column, lambda d: F.struct(d["stage"].alias("stage"), d["code"].alias("code"))))
    found = rows.select(*keys, "status", F.inline(kinds))
    part = F.pmod(F.xxhash64(*keys), F.lit(salts_of(rows.sparkSession)))
    parts = Window.partitionBy("stage", "code", "__part").orderBy(*keys)
    groups = Window.partitionBy("stage", "code").orderBy(*keys)
    kept = found.withColumn("__part", part).withColumn("place", F.row_number().over(parts)).where(F.col("place") <= limit)
    kept = kept.withColumn("place", F.row_number().over(groups)).where(F.col("place") <= limit).drop("__part")
    totals = found.groupBy("stage", "code").agg(F.count(F.lit(1)).alias("n_rows"))
    totals = totals.select(F.col("stage").alias("__stage"), F.col("code").alias("__code"), "n_rows")
    # no diagnostic is without a stage, some of foreign rows may be without a code
    same = (F.col("stage").eqNullSafe(F.col("__stage"))) & F.col("code").eqNullSafe(F.col("__code"))
    return kept.join(totals, same).drop("__stage", "__code").withColumn("truncated", F.col("n_rows") > limit)


def item_rows(items: DataFrame) -> DataFrame:
    """Report items: status, row reference, diagnostics with their severity and context; no payload.

    Rows of a named source have it in their reference, and in the id of the row."""
    marked = [f"transform({c}, d -> named_struct('severity', '{severity}', 'stage', d.stage, 'code', d.code, 'field', d.field, 'message', d.message))"
              for c, severity in (("errors", "error"), ("warnings", "warning"))]
    context = F.col("context") if "context" in items.columns else F.expr("cast(map() as map<string,string>)")
    source = F.nullif(F.col("source_id"), F.lit("")) if "source_id" in items.columns else F.lit(None).cast("string")
    return items.select(
        "status",
        F.struct(
            source.alias("source_id"),
            "line_no",
            F.concat(F.coalesce(F.concat(source, F.lit("#")), F.lit("")), F.lit("line:"), F.col("line_no")).alias("row_id"),
            F.lit("match_key").alias("identity_primary"),
            F.col("match_key").alias("identity_value"),
        ).alias("row_ref"),
        F.expr(f"concat({', '.join(marked)})").alias("diagnostics"),
        context.alias("context"),
    )
