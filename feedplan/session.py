"""Session settings the flows are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Parsing a feed gives projections with dozens of expressions.  HotSpot
    # does not compile methods above 8000 bytes of bytecode, so let Spark fall
    # back to split projections instead of one huge interpreted method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    # Lookups are shaped so that adaptive execution can split frequent keys.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A flow has dozens of joins, and every side that is broadcast passes
    # through the driver. Sizes are those of compressed files and shuffles; the
    # rows take several times as much.
    "spark.sql.autoBroadcastJoinThreshold": "2MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "2MB",
}


# Bytes of input per shuffle partition before adaptive execution merges them.
PARTITION_BYTES = 128 * 1024 * 1024


def configure(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Apply the settings; safe to call again.

    With the size of the input, shuffles start with enough partitions for it;
    adaptive execution merges those that turn out small.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    # File splits must not depend on how many executors are up at the moment:
    # record numbering scans a feed twice.
    if not spark.conf.get("spark.sql.files.minPartitionNum", None):
        spark.conf.set("spark.sql.files.minPartitionNum", str(max(1, spark.sparkContext.defaultParallelism)))
    if input_bytes:
        wanted = max(spark.sparkContext.defaultParallelism, -(-input_bytes // PARTITION_BYTES))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(wanted))
    return spark
