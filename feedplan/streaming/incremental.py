"""Incremental synchronisation: each batch of files is planned against the
snapshot that the previous batch left, and merged into the next version.

A batch rewrites the buckets of the records it changes, and no others. A
version is named by its batch.  When a batch is repeated after a failure it
reads the same previous version and takes the place of its first try, so the
result does not change; nor do its secrets, which the vault stores once.  There is no event time: the last arrival of a key wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from feedplan.functions.text import clean_null_token
from feedplan.operators.apply import changed_records
from feedplan.plans import employees, sync
from feedplan.sources.snapshot_store import Changes, SnapshotStore
from feedplan.sources.staging import staged

DATASET = employees.DATASET


def feed_schema() -> T.StructType:
    """Arriving files carry the record number next to the raw cells."""
    cells = [T.StructField(c, T.StringType()) for c in employees.RAW_COLUMNS]
    return T.StructType([T.StructField("line_no", T.LongType()), *cells])


def read_arrivals(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema(feed_schema())
        .option("header", True)
        .option("escape", '"')
        .option("columnPruning", False)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(path)
        .select(F.col("_metadata.file_path").alias("source_id"), "*")
    )


def snapshot_schema() -> T.StructType:
    return T.StructType.fromDDL(sync.cache_schema(DATASET))


def apply_batch(
    batch: DataFrame, version: int, store: SnapshotStore, orgs: DataFrame, run_id: str, vault: str | None = None
) -> None:
    """Plan one batch against the version before it and publish the result.

    Rows without a source are known by their batch.
    """
    cells = [f"{clean_null_token(c)} as {c}" for c in employees.RAW_COLUMNS]
    source = "source_id" if "source_id" in batch.columns else f"'batch {version}' as source_id"
    raw = batch.selectExpr(source, "line_no", "concat('line:', line_no) as record_id", *cells)
    target = store.read(DATASET, snapshot_schema(), before=version)
    plan = sync.plan_import(raw, target, orgs, employees.enrich_spec(run_id), vault=vault, batch=str(version))
    store.merge({DATASET: Changes(staged(changed_records(plan.items, target), "changed"))}, run_id, version=version)


def incremental_sync(
    arrivals: DataFrame,
    store: SnapshotStore,
    orgs: DataFrame,
    checkpoint: str,
    run_id: str = "run",
    first_version: int = 1,
    vault: str | None = None,
) -> StreamingQuery:
    """Process everything that has arrived, then stop.  ``vault`` is the path of the vault that secrets go to."""

    def run(batch: DataFrame, batch_id: int) -> None:
        apply_batch(batch, first_version + batch_id, store, orgs, run_id, vault)

    return (
        arrivals.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
