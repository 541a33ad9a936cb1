"""Staged tables in the shared folder of the cluster.

A staged table cuts the lineage with files that survive the loss of an
executor, and its true size is known to the optimizer afterwards, which then
decides about broadcasts by measurement.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_made: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    Only where the session names none and all executors run in this process
    (a test on one machine) a temporary folder is made, one for each
    application; on a cluster every machine would see a folder of its own.
    """
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError(f"{_SETTING} must name a folder that all executors share")
        folder = _made.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="feedplan-")
        _made[spark.sparkContext.applicationId] = folder
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write once, read back."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
