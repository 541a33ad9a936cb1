"""Versioned snapshot tables in hash buckets.

The rows of a table lie in buckets by the hash of their key, which is the first
column. A version writes the buckets that it changes, each to a folder of its
own, and leaves the others where they are; the manifest tells the folder of
every bucket. So a small batch reads and rewrites the buckets of its keys only,
a removed row is gone with the next writing of its bucket, and a reader scans
one folder for each bucket, however many versions there were.

All writing is done before one append to the manifest makes it visible, for all
datasets of a commit together. A repeated version takes the place of its first
try. Folders are never written twice, so nobody reads what another one writes;
of two writers of one version the last to publish wins.

Choose the number of buckets so that a bucket is about as large as a task may be
when it is rewritten; it is fixed by the first commit of a dataset.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MANIFEST = (
    "dataset string, version bigint, run_id string, committed_at timestamp, meta map<string,string>, "
    "folder string, buckets int, written array<int>, filled array<int>"
)


@dataclass(frozen=True)
class Changes:
    """New and changed rows, unique by key, and the keys of removed rows (one column, the key)."""

    rows: DataFrame
    removed: DataFrame | None = None


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 16) -> None:
        self._spark = spark
        self._root = root.rstrip("/")
        self._buckets = buckets

    def manifest(self) -> DataFrame:
        """All committed versions; small, one row per dataset and commit."""
        try:
            return self._spark.read.schema(_MANIFEST).parquet(f"{self._root}/manifest")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return self._spark.createDataFrame([], _MANIFEST)
            raise

    def _commits(self, dataset: str, before: int | None = None) -> list[Row]:
        """Commits of a dataset in order; of a version that was committed again, the last one. A row for each commit."""
        rows = self.manifest().filter(F.col("dataset") == dataset)
        rows = rows if before is None else rows.filter(F.col("version") < before)
        found = rows.agg(F.collect_list(F.struct(*rows.columns))).first()[0]
        last = {r["version"]: r for r in sorted(found, key=lambda r: r["committed_at"])}
        return [last[v] for v in sorted(last)]

    def current_version(self, dataset: str, before: int | None = None) -> int | None:
        """Latest committed version, optionally below a given one."""
        commits = self._commits(dataset, before)
        return commits[-1]["version"] if commits else None

    def folders(self, dataset: str, before: int | None = None, only: Iterable[int] | None = None) -> dict[int, str]:
        """Where the rows of each bucket lie; buckets without rows are left out."""
        return self._folders(dataset, self._commits(dataset, before), only)

    def _folders(self, dataset: str, commits: list[Row], only: Iterable[int] | None) -> dict[int, str]:
        owner: dict[int, str | None] = {}
        for commit in commits:
            filled = set(commit["filled"])
            owner.update({b: commit["folder"] if b in filled else None for b in commit["written"]})
        wanted = owner if only is None else set(only)
        return {b: f"{self._root}/data/{dataset}/{folder}/bucket={b}" for b, folder in owner.items() if folder and b in wanted}

    def read(self, dataset: str, schema: T.StructType, before: int | None = None, only: Iterable[int] | None = None) -> DataFrame:
        """The table as of a version, or some buckets of it; empty when nothing is committed yet."""
        return self._scan(self.folders(dataset, before, only), schema)

    def _scan(self, folders: dict[int, str], schema: T.StructType) -> DataFrame:
        return self._spark.read.schema(schema).parquet(*sorted(folders.values())) if folders else self._spark.createDataFrame([], schema)

    def touched(self, dataset: str, *keys: DataFrame) -> list[int]:
        """Buckets of the keys in the first column of each table: as many numbers as there are buckets at most."""
        return self._touched(self._size(self._commits(dataset)), *keys)

    def _size(self, commits: list[Row]) -> int:
        return commits[0]["buckets"] if commits else self._buckets

    def _touched(self, n: int, *keys: DataFrame) -> list[int]:
        found = None
        for table in keys:
            one = table.select(_bucket(table.columns[0], n).alias("bucket")).distinct()
            found = one if found is None else found.union(one)
        return found.agg(F.sort_array(F.collect_set("bucket"))).first()[0]

    def commit(
        self,
        tables: Mapping[str, DataFrame],
        run_id: str,
        meta: Mapping[str, Mapping[str, str]] | None = None,
        version: int | None = None,
    ) -> dict[str, int]:
        """Write whole tables, then publish them together."""
        written = {}
        for dataset, table in tables.items():
            commits = self._commits(dataset)
            written[dataset] = (table, list(range(self._size(commits))), commits)
        return self._write(written, run_id, meta or {}, version)

    def merge(
        self,
        changes: Mapping[str, Changes],
        run_id: str,
        meta: Mapping[str, Mapping[str, str]] | None = None,
        version: int | None = None,
    ) -> dict[str, int]:
        """Put changed rows into the buckets that they belong to and take removed ones out, for all datasets together.

        Of the table only the touched buckets are read and written. A key that is both changed and removed stays.
        """
        written = {}
        for dataset, change in changes.items():
            key, schema = change.rows.columns[0], change.rows.schema
            gone = [change.rows.select(key)] + ([change.removed.toDF(key)] if change.removed is not None else [])
            commits = self._commits(dataset)
            touched = self._touched(self._size(commits), *gone)
            earlier = commits if version is None else [c for c in commits if c["version"] < version]
            table = self._scan(self._folders(dataset, earlier, touched), schema)
            for keys in gone:
                table = table.join(keys, key, "left_anti")
            written[dataset] = (table.unionByName(change.rows), touched, commits)
        return self._write(written, run_id, meta or {}, version)

    def _write(self, tables: Mapping[str, tuple[DataFrame, Sequence[int], list[Row]]], run_id: str, meta: Mapping, version: int | None) -> dict[str, int]:
        published = []
        for dataset, (table, buckets, commits) in tables.items():
            number = version if version is not None else (commits[-1]["version"] if commits else 0) + 1
            n, folder = self._size(commits), f"{number:09d}-{uuid.uuid4().hex}"
            path = f"{self._root}/data/{dataset}/{folder}"
            # a large bucket may be written by several tasks
            dealt = table.withColumn("bucket", _bucket(table.columns[0], n)).hint("rebalance", "bucket")
            dealt.write.partitionBy("bucket").parquet(path)
            filled = self._filled(path)
            published.append((dataset, number, run_id, dict(meta.get(dataset, {})), folder, n, list(buckets), filled))
        self._publish(published)
        return {row[0]: row[1] for row in published}

    def _filled(self, path: str) -> list[int]:
        """Buckets that have rows: found by their folders, no file is read."""
        try:
            return self._spark.read.schema("bucket int").parquet(path).agg(F.sort_array(F.collect_set("bucket"))).first()[0]
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return []
            raise

    def _publish(self, published: list[tuple]) -> None:
        columns = [c.split()[0] for c in _MANIFEST.split(", ")]
        given = ", ".join(c for c in _MANIFEST.split(", ") if not c.startswith("committed_at"))
        rows = self._spark.createDataFrame(published, given).withColumn("committed_at", F.current_timestamp()).select(*columns)
        rows.coalesce(1).write.mode("append").parquet(f"{self._root}/manifest")

    def clear(self, schemas: Mapping[str, T.StructType], run_id: str) -> dict[str, int]:
        """Publish empty versions; returns the number of removed rows."""
        removed = {d: self.read(d, s).count() for d, s in schemas.items()}
        self.commit({d: self._spark.createDataFrame([], s) for d, s in schemas.items()}, run_id)
        return removed

    def status(self, schemas: Mapping[str, T.StructType]) -> DataFrame:
        """Row count and metadata of the current version of every dataset."""
        counts = None
        for dataset, schema in schemas.items():
            one = self.read(dataset, schema).agg(F.count("*").alias("n_rows")).select(
                F.lit(dataset).alias("dataset"), "n_rows"
            )
            counts = one if counts is None else counts.unionByName(one)
        latest = self.manifest().groupBy("dataset").agg(F.max_by("meta", F.struct("version", "committed_at")).alias("meta"))
        return counts.join(latest, "dataset", "left")


def _bucket(key: str, n: int) -> Column:
    """Bucket of a key; an integer key has the bucket of its text, whatever its type."""
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(n)).cast("int")
