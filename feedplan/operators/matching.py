"""Business keys and their match against a target snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedplan.functions.text import is_deleted, normalize_whitespace
from feedplan.operators.lookup import distinct_keys, lookup

# Results of a match.
MATCHED, CONFLICT, NOT_FOUND = "matched", "conflict", "not_found"


def match_key(parts: Sequence[str], delimiter: str = "|", strict: bool = True, normalized: bool = False) -> str:
    """Whitespace-normalised parts joined by the delimiter (SQL text).

    A missing part counts as empty; in strict mode an empty part gives NULL.
    ``normalized`` parts are taken as they are (NULL instead of blank).
    """
    texts = list(parts) if normalized else [normalize_whitespace(p) for p in parts]
    if strict:
        # concat gives NULL as soon as one part is NULL
        return "concat({})".format(
            f", '{delimiter}', ".join(texts if normalized else [f"nullif({t}, '')" for t in texts])
        )
    return f"concat_ws('{delimiter}', {', '.join(f"coalesce({t}, '')" for t in texts)})"


def active(target: DataFrame, include_deleted: bool = False) -> DataFrame:
    """Target records that may be matched."""
    if include_deleted:
        return target
    return target.where(f"not {is_deleted()}")


def key_index(target: DataFrame, columns: Sequence[str], key: str = "match_key") -> DataFrame:
    """One row per key: number of records, and the record if it is the only
    one.  Keys are counted by hash aggregation, which collapses duplicates
    before the shuffle; only single records are joined back."""
    held = target.filter(F.col(key).isNotNull())
    counts = held.groupBy(key).agg(F.count("*").alias("n_candidates"))
    records = held.select(key, F.struct(*columns).alias("candidate"))
    single = records.join(counts.where("n_candidates = 1"), key)
    several = counts.where("n_candidates > 1").select(key, F.lit(None).cast(records.schema["candidate"].dataType).alias("candidate"), "n_candidates")
    return single.select(key, "candidate", "n_candidates").unionByName(several).select(key, "n_candidates", "candidate")


def match_target(
    rows: DataFrame,
    target: DataFrame,
    columns: Sequence[str],
    include_deleted: bool = False,
    key: str = "match_key",
) -> DataFrame:
    """Add ``n_candidates``, ``match_status`` and ``candidate`` to every row."""
    index = key_index(active(target, include_deleted), columns, key)
    matched = lookup(rows, index, {key: key}, "line_no")
    return matched.selectExpr(
        *rows.columns,
        "coalesce(n_candidates, 0L) as n_candidates",
        f"case when n_candidates is null then '{NOT_FOUND}' when n_candidates = 1 then '{MATCHED}' "
        f"else '{CONFLICT}' end as match_status",
        "candidate",
    )


def probe_ids(rows: DataFrame, target: DataFrame, column: str, key: str = "_id", marker: str = "id_taken") -> DataFrame:
    """Mark rows whose id is in use in the target."""
    probed = lookup(rows, distinct_keys(target, key, marker=marker), {column: key}, "line_no")
    return probed.withColumn(marker, F.coalesce(marker, F.lit(False)))


def probe_codes(rows: DataFrame, target: DataFrame, column: str, code: str, key: str = "match_key") -> DataFrame:
    """Mark rows whose code is held in the target, and whether by the row's
    own key.  Deleted holders count."""
    held = lookup(rows, distinct_keys(target, code, marker="code_held"), {column: code}, "line_no")
    mine = distinct_keys(target, code, key, marker="code_mine")
    both = lookup(held, mine, {column: code, key: key}, "line_no")
    return both.withColumns({m: F.coalesce(m, F.lit(False)) for m in ("code_held", "code_mine")})
