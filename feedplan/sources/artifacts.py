"""Plan and report artefacts as JSON."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedplan.functions.masking import MASK, mask_nested
from feedplan.operators import report

# Counters of a plan.
COUNTERS = ("rows_total", "valid_rows", "failed_rows", "planned_create", "planned_update", "skipped")


def masked_items(items: DataFrame) -> DataFrame:
    """Plan items with every sensitive value masked."""
    return items.select(*[mask_nested(F.col(f.name), f.dataType).alias(f.name) for f in items.schema.fields])


def write_plan(items: DataFrame, summary: DataFrame, meta: Mapping[str, str], path: str) -> None:
    """Items as JSON lines below ``path``/items, meta and summary (one row)
    below ``path``/header.  The header is written last: a plan without one is
    incomplete."""
    masked_items(items).write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/items")
    fields = [F.lit(v).alias(k) for k, v in meta.items()]
    header = summary.select(F.struct(*fields).alias("meta"), F.struct(*COUNTERS).alias("summary"))
    header.write.mode("overwrite").json(f"{path}/header")


def read_plan(spark: SparkSession, path: str) -> DataFrame:
    """Items of a plan folder, cleaned like those of a plan document."""
    header = spark.read.text(f"{path}/header")
    require_dataset(header.selectExpr("value as body"))
    lines = spark.read.text(f"{path}/items")
    return clean_items(lines.select(F.try_parse_json("value").alias("item")))


def require_dataset(documents: DataFrame) -> str:
    """Dataset named by the header of a plan (one row)."""
    meta = documents.select(F.try_parse_json("body").alias("doc")).selectExpr(f"{_DATASET} as dataset").first()
    if meta is None or not meta["dataset"]:
        raise ValueError("Invalid plan format: dataset is missing in meta")
    return meta["dataset"]


_DATASET = (
    "coalesce(nullif(try_variant_get(doc, '$.meta.dataset', 'string'), ''), "
    "nullif(try_variant_get(doc, '$.meta.dataset_name', 'string'), ''))"
)


def parse_plan_documents(documents: DataFrame, *carried: str) -> DataFrame:
    """Plan documents ``{meta, summary, items}`` given as text in ``body``.

    Adds ``dataset``, the counters (absent or null counts as 0), ``items``
    (ARRAY<VARIANT>) and ``plan_error``, NULL for a good document.
    """
    doc = documents.select(*carried, F.try_parse_json("body").alias("doc"))
    counters = [
        f"coalesce(try_variant_get(doc, '$.summary.{c}', 'bigint'), 0L) as {c}" for c in COUNTERS
    ]
    parsed = doc.selectExpr(
        "*",
        f"{_DATASET} as dataset",
        "try_variant_get(doc, '$.items', 'array<variant>') as items",
    )
    # the shape of a document is only looked at when something is missing
    error = (
        "case when dataset is not null and items is not null then null "
        "when doc is null or not startswith(schema_of_variant(doc), 'OBJECT') then 'Invalid plan format: root must be object' "
        "when items is null and try_variant_get(doc, '$.items', 'variant') is not null "
        "then 'Invalid plan format: items must be list' "
        "when dataset is null then 'Invalid plan format: dataset is missing in meta' end"
    )
    return parsed.selectExpr(
        *carried,
        "dataset",
        *counters,
        "coalesce(items, cast(array() as array<variant>)) as items",
        f"{error} as plan_error",
    )


def plan_document_items(documents: DataFrame, *carried: str) -> DataFrame:
    """Cleaned items of good documents; a bad document fails the job."""
    parsed = parse_plan_documents(documents, *carried)
    checked = parsed.withColumn("items", F.expr("if(plan_error is null, items, raise_error(plan_error))"))
    items = checked.select(*carried, F.posexplode_outer("items").alias("pos", "item")).where("pos is not null")
    return clean_items(items, *carried, "pos")


def read_plan_document(spark: SparkSession, path: str) -> DataFrame:
    """Items of a plan kept as one JSON document.  The format needs one task
    per document; large plans use the folder format."""
    return plan_document_items(spark.read.text(path, wholetext=True).withColumnRenamed("value", "body"))


_ITEM = (
    "struct<row_id:string,line_no:bigint,op:string,resource_id:string,desired_state:map<string,string>,"
    "changes:map<string,string>,source_ref:map<string,string>,secret_fields:array<string>>"
)


def clean_items(items: DataFrame, *carried: str) -> DataFrame:
    """Typed plan items out of ``item`` (VARIANT).

    Anything but an object is dropped, missing maps are empty, a password that
    equals the mask is removed.  An item is read once, into a record; the
    generator keeps the optimizer from reading it again for every field.
    """
    empty = "cast(map() as map<string,string>)"
    records = items.selectExpr(*carried, f"explode(array(try_variant_get(item, '$', '{_ITEM}'))) as i").where("i is not null")
    return records.selectExpr(
        *carried,
        "coalesce(i.row_id, '') as row_id",
        "i.line_no as line_no",
        "coalesce(i.op, '') as op",
        "coalesce(i.resource_id, '') as resource_id",
        f"map_filter(coalesce(i.desired_state, {empty}), (k, v) -> not (k <=> 'password' and v <=> '{MASK}')) as desired_state",
        f"coalesce(i.changes, {empty}) as changes",
        "i.source_ref as source_ref",
        "coalesce(i.secret_fields, cast(array() as array<string>)) as secret_fields",
    )


def report_document(rows: DataFrame, meta: Mapping[str, str], limit: int = 200, include_skipped: bool = False) -> DataFrame:
    """The whole report as one JSON text (column ``report``).

    ``rows`` are staged report rows; the document holds counters, one entry
    per stage and at most ``limit`` items, whatever the size of the run.
    """
    kept = report.item_rows(report.report_items(rows, limit, include_skipped))
    items = kept.agg(F.sort_array(F.collect_list(F.struct("row_ref", "status", "diagnostics", F.map_entries("context").alias("context")))).alias("items"))
    stages = report.diagnostics_by_stage(rows).agg(
        F.sort_array(F.collect_list(F.struct("stage", "errors_total", "warnings_total"))).alias("by_stage")
    )
    summary = report.report_summary(rows)
    truncated = report.items_truncated(rows, limit, include_skipped)
    info = [F.lit(v).alias(k) for k, v in meta.items()]
    counters = [F.col(c) for c in summary.columns if c != "status"]
    document = F.struct(
        F.col("status"),
        F.struct(*info, F.lit(limit).alias("items_limit"), truncated.scalar().alias("items_truncated")).alias("meta"),
        F.struct(*counters, stages.scalar().alias("by_stage")).alias("summary"),
        items.scalar().alias("items"),
    )
    return summary.select(F.to_json(document, {"ignoreNullFields": "false"}).alias("report"))


def write_report(rows: DataFrame, meta: Mapping[str, str], path: str, limit: int = 200) -> None:
    report_document(rows, meta, limit).write.mode("overwrite").text(path)
