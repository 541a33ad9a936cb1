"""Secrets: the vault table and its lookups.

Secret values live in the vault only.  Rows and plans carry field names;
``hide_secrets`` masks the values before anything is staged.

The vault is a log of appends.  Each one writes a folder of its own, and counts
from when its entry is published; the entry names the run and the batch, so a
batch that is repeated finds its secrets instead of storing them again.
"""

from __future__ import annotations

import secrets as csprng
import uuid
from collections.abc import Sequence

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from feedplan.functions import diagnostics as dx
from feedplan.functions.masking import MASK
from feedplan.operators.enrich import row_key
from feedplan.operators.lookup import lookup, salts_of

VAULT = "dataset string, field string, match_key string, value string, run_id string, updated_at string, append bigint, seq bigint"
_APPENDS = "dataset string, run_id string, batch string, append bigint, folder string, committed_at timestamp"

#: Lines of one source that the order inside an append has room for.
_LINES = 1 << 40


def _fill_missing(values: pd.Series) -> pd.Series:
    drawn = csprng.token_bytes(16 * len(values)).hex()
    return pd.Series([drawn[i * 32 : i * 32 + 32] for i in range(len(values))], index=values.index)


def hide_secrets(rows: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Rows that may be staged: secret columns and the values of ``secrets`` are masked, the names stay."""
    shown = {f: f"if({f} is null, null, '{MASK}') as {f}" for f in fields if f in rows.columns}
    shown["secrets"] = f"transform_values(secrets, (k, v) -> '{MASK}') as secrets"
    return rows.selectExpr(*[shown.get(c, c) for c in rows.columns])


def vault_rows(
    rows: DataFrame,
    secrets: DataFrame,
    dataset: str,
    run_id: str,
    updated_at: str,
    generate: Sequence[str] = ("password",),
    append: int = 0,
) -> DataFrame:
    """Vault rows of clean rows with a key: one per secret field, with ``generated``.

    ``secrets`` has the values by row key.  Fields in ``generate`` get a fresh
    random value where the feed has none.  Random values are drawn by the write
    itself, so write the result at once and read secrets back from the vault; a
    task that runs again replaces its own output.  ``append`` numbers the
    appends to one vault, ``seq`` orders the rows of one by source and line.
    """
    keys = row_key(rows)
    clean = rows.where(f"{dx.CLEAN} and match_key is not null").select(*keys, "match_key", F.map_keys("secrets").alias("__names"))
    # a plain explode would leave out rows without secrets first, and the optimizer moves that filter with all its
    # parsing to where the cells are read, before they are dealt out
    values = secrets.select(*keys, F.explode_outer("secrets").alias("field", "value")).where("field is not null")
    known = clean.drop("__names").join(values, keys).withColumn("generated", F.lit(False))
    if generate:
        # one Arrow batch of the absent ones only; values that the feed
        # brought never pass through Python
        absent = F.explode(F.array_except(F.array(*[F.lit(g) for g in generate]), "__names")).alias("field")
        draw = F.pandas_udf(_fill_missing, "string").asNondeterministic()
        drawn = clean.select(*keys, "match_key", absent).withColumns({"value": draw(F.lit("").cast("string")), "generated": F.lit(True)})
        known = known.unionByName(drawn)
    place = "line_no"
    if "source_id" in keys:
        # one row for each file; sources go by their names
        order = Window.orderBy("__source")
        sources = clean.select(F.col("source_id").alias("__source")).distinct().select("__source", (F.row_number().over(order) - 1).cast("bigint").alias("__place"))
        known = lookup(known, sources, {"source_id": "__source"}, "line_no")
        place = f"coalesce(__place, 0L) * {_LINES} + line_no"
    seq = f"if(line_no between 0 and {_LINES - 1}, {place}, raise_error('a line number is out of bounds'))"
    return known.select(
        F.lit(dataset).alias("dataset"),
        "field",
        "match_key",
        "value",
        F.lit(run_id).alias("run_id"),
        F.lit(updated_at).alias("updated_at"),
        F.lit(append).cast("bigint").alias("append"),
        F.expr(seq).cast("bigint").alias("seq"),
        "generated",
    )


def _flagged(rows: DataFrame, condition: str, code: str, field: str, message: str) -> DataFrame:
    error = dx.diagnostic(dx.ENRICH, code, field, message)
    columns = {"errors": dx.gather(["errors", dx.emit(condition, error)])}
    return rows.selectExpr(*[f"{columns.get(c, c)} as {c}" for c in rows.columns])


def store_secrets(
    rows: DataFrame,
    secrets: DataFrame,
    path: str,
    dataset: str,
    run_id: str,
    updated_at: str,
    generate: Sequence[str] = ("password",),
    batch: str | None = None,
) -> DataFrame:
    """Append the secrets of clean rows to the vault at ``path``; the rows, with an error where that was not possible.

    A row without a key cannot be looked up later (``MATCH_KEY_MISSING``).  An
    append succeeds or fails as a whole: when it fails, all rows that should
    have been stored get ``SECRET_STORE_ERROR`` and leave the plan.

    A ``batch`` of a run is stored once.  When it is repeated, nothing is
    written or drawn: its secrets are in the vault, and those that were drawn
    then are found again.  Without a batch every call appends.
    """
    spark = rows.sparkSession
    try:
        so_far = _appends(spark, path)
        if batch is None or not any((a["dataset"], a["run_id"], a["batch"]) == (dataset, run_id, batch) for a in so_far):
            append = max((a["append"] for a in so_far), default=-1) + 1
            folder = uuid.uuid4().hex
            stored = vault_rows(rows, secrets, dataset, run_id, updated_at, generate, append)
            stored.drop("generated").write.parquet(f"{path}/data/{folder}")
            entry = spark.createDataFrame([(dataset, run_id, batch if batch is not None else folder, append, folder)], _APPENDS.rsplit(",", 1)[0])
            entry.withColumn("committed_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{path}/appends")
    except (PySparkException, Py4JJavaError):
        wanted = " or ".join(["size(secrets) > 0", *(f"not map_contains_key(secrets, '{g}')" for g in generate)])
        return _flagged(rows, f"{dx.CLEAN} and ({wanted})", "SECRET_STORE_ERROR", "secrets", "secrets could not be stored")
    return store_errors(rows)


def store_errors(rows: DataFrame) -> DataFrame:
    """Rows with secrets but without a key cannot be stored."""
    homeless = f"{dx.CLEAN} and match_key is null and size(secrets) > 0"
    return _flagged(rows, homeless, "MATCH_KEY_MISSING", "matchKey", "match_key is required to store secrets")


def _appends(spark: SparkSession, path: str) -> list[Row]:
    """The appends that count, one for each batch: of two that were published for the same one, the first."""
    try:
        rows = spark.read.schema(_APPENDS).parquet(f"{path}/appends").agg(F.collect_list(F.struct("*"))).first()[0]  # a row for each append
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    first: dict[tuple, Row] = {}
    for row in sorted(rows, key=lambda r: (r["committed_at"], r["folder"])):
        first.setdefault((row["dataset"], row["run_id"], row["batch"]), row)
    return list(first.values())


def read_vault(spark: SparkSession, path: str) -> DataFrame:
    """The vault table: what published appends have written; empty when nothing has been stored yet."""
    folders = [f"{path}/data/{a['folder']}" for a in _appends(spark, path)]
    return spark.read.schema(VAULT).parquet(*folders) if folders else spark.createDataFrame([], VAULT)


def latest_secrets(vault: DataFrame, run_id: str | None = None) -> DataFrame:
    """Current value per (dataset, field, match_key).

    The first value of the requested run if that run stored one, else the
    last value of all, in the order of the appends and, inside one, of sources
    and lines.  The position is found first, by hash aggregation of one number;
    its value is joined back.
    """
    keys = ["dataset", "field", "match_key"]
    if "append" in vault.columns:  # one number for both, wider than 64 bits
        vault = vault.withColumn("seq", F.expr("cast(append as decimal(18, 0)) * cast('10000000000000000000' as decimal(20, 0)) + cast(seq as decimal(19, 0))").cast("decimal(38, 0)"))
    last = "max(seq)"
    if run_id is not None:
        of_run = run_id.replace("'", "\\'")
        last = f"coalesce(min(seq) filter (where run_id = '{of_run}'), {last})"
    places = vault.groupBy(*keys).agg(F.expr(last).alias("seq"))
    found = vault.select(*keys, "seq", "value").join(places, [*keys, "seq"])
    return found.groupBy(*keys).agg(F.max("value").alias("value"))


def keyed_fallback(requests: DataFrame, table: DataFrame) -> DataFrame:
    """Secret of each request by the most specific entry.

    Entries are keyed by (dataset, field, row_id, line_no); NULL in the table
    means "any".  Order: both, row only, line only, neither.  ``table`` is
    unique per key.  ``request_no`` identifies a request.

    Each request asks for its three specific keys at once: one join, and one
    minimum over what it finds.  The default of a field answers by a lookup
    among the few fields there are.
    """
    specific = table.where("row_id is not null or line_no is not null")
    asked = requests.selectExpr(
        "request_no", "dataset", "field",
        "inline(array(struct(1 as level, row_id as row_key, line_no as line_key), struct(2 as level, row_id as row_key, null as line_key), "
        "struct(3 as level, null as row_key, line_no as line_key)))",
    ).where("(level = 3 or row_key is not null) and (level = 2 or line_key is not null)")
    keyed = "concat_ws('|', field, level, coalesce(cast(row_key as string), ''), coalesce(cast(line_key as string), ''))"
    asked = asked.selectExpr("request_no", "dataset", "level", f"{keyed} as __key")
    level = "case when row_id is null then 3 when line_no is null then 2 else 1 end"
    entries = specific.selectExpr("dataset", "field", f"{level} as level", "row_id as row_key", "line_no as line_key", "value")
    entries = entries.selectExpr("dataset", f"{keyed} as __key", "value")
    hits = lookup(asked, entries, {"dataset": "dataset", "__key": "__key"}, "request_no", how="inner")
    best = hits.groupBy("request_no").agg(F.min(F.struct("level", "value")).alias("best"))
    default = table.where("row_id is null and line_no is null").select("dataset", "field", F.col("value").alias("__any"))
    general = lookup(requests, default, {"dataset": "dataset", "field": "field"}, "request_no", salts=salts_of(requests.sparkSession))
    found = general.join(best, "request_no", "left")
    return found.withColumn("value", F.coalesce("best.value", "__any")).drop("best", "__any")


def attach_secrets(items: DataFrame, latest: DataFrame, dataset: str, fields: Sequence[str]) -> DataFrame:
    """Add one ``secret_<field>`` column per field for the items that ask for it."""
    for field in fields:
        values = latest.filter((F.col("dataset") == dataset) & (F.col("field") == field)).select(
            F.col("match_key").alias("__vault_key"), F.col("value").alias(f"__secret_{field}")
        )
        wanted = F.array_contains("secret_fields", field)
        asked = items.withColumn("__wanted_key", F.when(wanted, F.col("source_ref")["match_key"]))
        items = (
            lookup(asked, values, {"__wanted_key": "__vault_key"}, "line_no")
            .withColumnRenamed(f"__secret_{field}", f"secret_{field}")
            .drop("__wanted_key")
        )
    return items


def missing_secret(fields: Sequence[str]) -> str:
    """Name of the first required secret without a value, else NULL (SQL text)."""
    gaps = [f"when array_contains(secret_fields, '{f}') and coalesce(secret_{f}, '') = '' then '{f}'" for f in fields]
    return f"case {' '.join(gaps)} end"
