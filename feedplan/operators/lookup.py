"""Skew-safe equi lookups.

A lookup adds the columns of at most one right row to every left row.  The
right side is unique per key, so a left row is never multiplied.  Three
things keep one frequent key from ending up in one task:

* rows without a key never match; they get their own salt values and spread
  over all partitions instead of meeting in the partition of NULL;
* the join runs on (key, salt).  The salt of the right side is always 0, but
  it makes the right side's aggregation and the join use different
  partitionings, so both join inputs are plain shuffle stages and adaptive
  execution may split an oversized left partition (it does not touch a join
  whose input is aggregated in the same stage);
* with ``salts=n`` a small right side is repeated n times and the left rows
  of each key are spread over n partitions, with or without adaptive
  execution.

No broadcast is forced: Spark broadcasts a right side only when its measured
size is below ``spark.sql.autoBroadcastJoinThreshold``, which
``feedplan.session`` keeps small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SALT = "__salt"


def salts_of(spark: SparkSession) -> int:
    """Parts that one frequent key is spread over: as many as a shuffle has tasks."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def lookup(
    left: DataFrame,
    right: DataFrame,
    on: dict[str, str],
    spread_by: str,
    how: str = "left",
    salts: int = 1,
) -> DataFrame:
    """Join ``right`` to ``left``; ``on`` maps left columns to right columns.

    ``right`` must be unique per key (any right side will do for a semi or
    anti join).  ``spread_by`` is a left column with many values (a row number)
    that the salt is derived from.  The key columns of the right side are not
    in the result.
    """
    no_key = " or ".join(f"`{k}` is null" for k in on)
    row = f"xxhash64(`{spread_by}`)"
    # rows without a key: many more values than tasks, so that they spread evenly
    null_salts = 8 * salts_of(left.sparkSession)
    salt = f"cast(if({no_key}, {1 + salts} + pmod({row}, {null_salts}), pmod({row}, {salts})) as int)"
    salted = left.withColumn(_SALT, F.expr(salt))

    keys = {r: f"__key_{i}" for i, r in enumerate(on.values())}
    # pmod(hash, 1) is always 0, but not a literal: the optimizer would fold a
    # literal away and with it the (key, salt) partitioning
    all_keys = ", ".join(f"`{r}`" for r in keys)
    salted_right = f"explode(sequence(0, {salts - 1}))" if salts > 1 else f"cast(pmod(xxhash64({all_keys}), 1) as int)"
    side = right.where(" and ".join(f"`{r}` is not null" for r in keys)).selectExpr(
        *[f"`{r}` as {n}" for r, n in keys.items()],
        *[f"`{c}`" for c in right.columns if c not in keys],
        f"{salted_right} as __right_salt",
    )
    matches = " and ".join([f"{_SALT} = __right_salt", *[f"`{k}` = {keys[r]}" for k, r in on.items()]])
    return salted.join(side, F.expr(matches), how).drop(_SALT, "__right_salt", *keys.values())


def distinct_keys(df: DataFrame, *columns: str, marker: str | None = None) -> DataFrame:
    """Unique non-NULL keys; duplicates collapse before the shuffle."""
    kept = df.where(" and ".join(f"`{c}` is not null" for c in columns))
    marked = [f"true as {marker}"] if marker else []
    return kept.selectExpr(*[f"`{c}`" for c in columns], *marked).distinct()


def keep_held(left: DataFrame, right: DataFrame, on: dict[str, str], spread_by: str) -> DataFrame:
    """Left rows whose key occurs on the right."""
    return lookup(left, distinct_keys(right, *on.values()), on, spread_by, "left_semi")


def drop_held(left: DataFrame, right: DataFrame, on: dict[str, str], spread_by: str) -> DataFrame:
    """Left rows whose key does not occur on the right."""
    return lookup(left, distinct_keys(right, *on.values()), on, spread_by, "left_anti")
