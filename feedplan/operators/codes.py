"""Codes by a keyed permutation: no two rows of a feed draw the same.

The codes of a width are numbered by a Feistel network, a permutation of all
of them that a key (run and dataset) selects. Rows are numbered too, and the
row with the n-th number gets the n-th code that the target does not hold. So
nothing has to be settled between rows, no attempt is needed, and every row is
served as long as there is a free code. The permutation runs backwards as well,
which turns the codes that are held into the ordinals to leave out.

All steps work on rows of a few numbers: a sort of the rows' keys by ranges, a
hash join of ordinals, and a join by number. Numbers are counted per partition
of the sort; only the counts of partitions are added up in one place.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedplan.operators.lookup import lookup
from feedplan.sources.staging import staged

ROUNDS = 4
#: Hex digits of a permuted code at most: products of half an ordinal stay inside 64 bits.
MOST_WIDTH = 15


def round_keys(seed: str) -> list[tuple[int, int]]:
    """An odd factor under 2^31 and a summand under 2^30 for each round."""
    drawn = [hashlib.sha256(f"{seed}|{i}".encode()).hexdigest() for i in range(ROUNDS)]
    return [(int(d[:8], 16) >> 1 | 1, int(d[8:16], 16) >> 2) for d in drawn]


def permuted(ordinal: Column, width: int, seed: str, backwards: bool = False) -> Column:
    """The place of an ordinal under 16^width in the permutation; the other way round with ``backwards``."""
    if not 1 <= width <= MOST_WIDTH:
        raise ValueError(f"permuted codes have 1 to {MOST_WIDTH} digits")
    bits = 2 * width
    mask = F.lit((1 << bits) - 1).cast("bigint")
    ordinal = ordinal.cast("bigint")
    left, right = F.shiftright(ordinal, bits), ordinal.bitwiseAND(mask)

    def shuffled(half: Column, key: tuple[int, int]) -> Column:
        return F.shiftright((half + F.lit(key[1])) * F.lit(key[0]).cast("bigint"), 16).bitwiseAND(mask)

    keys = round_keys(seed)
    if backwards:
        for key in reversed(keys):
            left, right = right.bitwiseXOR(shuffled(left, key)), left
    else:
        for key in keys:
            left, right = right, left.bitwiseXOR(shuffled(right, key))
    return F.shiftleft(left, bits) + right


def width_for(rows: int, least: int) -> int:
    """Digits that leave sixteen codes for each row."""
    return max(least, 1 + math.ceil(math.log(max(rows, 1), 16)))


def numbered(rows: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """The rows with ``__rank``, from 0 in the order of the keys."""
    placed = staged(rows.repartitionByRange(*keys).withColumn("__part", F.spark_partition_id()), name)
    before = F.sum("n").over(Window.orderBy("__at").rowsBetween(Window.unboundedPreceding, -1))  # a row for each partition
    counts = placed.groupBy(F.col("__part").alias("__at")).agg(F.count(F.lit(1)).alias("n"))
    firsts = counts.select("__at", F.coalesce(before, F.lit(0)).alias("__first"))
    inside = placed.withColumn("__inside", F.row_number().over(Window.partitionBy("__part").orderBy(*keys)))
    joined = inside.join(F.broadcast(firsts), F.col("__part") == F.col("__at"))  # as many rows as the shuffle has tasks
    return joined.withColumn("__rank", F.col("__first") + F.col("__inside") - 1).drop("__part", "__at", "__first", "__inside")


def permuted_codes(
    need: DataFrame, target: DataFrame, code: str, owner: str, prefix: str, width: int, seed: str, keys: Sequence[str]
) -> DataFrame:
    """(row key, pick) of the rows that need a code: one more than the number that is written in hex digits, 0 when
    no code is left.

    A code of this form that only the row's own record holds is kept, so a repeated run gives what an earlier one has
    given; of several rows of one record the first keeps it. Rows without an owner have no record.
    """
    held = target.where(F.col(code).rlike(rf"\A\Q{prefix}\E[0-9a-f]{{{width}}}\z"))
    number = F.conv(F.right(code, F.lit(width)), 16, 10).cast("bigint")
    holders = held.groupBy(number.alias("number")).agg(F.min(owner).alias("__lo"), F.max(owner).alias("__hi"))
    own = holders.where("__lo = __hi").groupBy(F.col("__lo").alias("__who")).agg(F.min("number").alias("__own"))
    asked = need.select(*keys, owner)
    mine = lookup(asked, own, {owner: "__who"}, keys[-1], how="inner")
    kept = mine.groupBy("__own").agg(F.min(F.struct(*keys)).alias("__row"))
    kept = staged(kept.select("__row.*", (F.col("__own") + 1).alias("pick")), "kept_codes")

    rest = numbered(asked.select(*keys).join(kept, list(keys), "left_anti"), keys, "code_rows")
    taken = staged(held.select(permuted(number, width, seed, backwards=True).alias("ordinal")).distinct(), "held_codes")
    # as many ordinals as rows and held codes: no row can need more
    ordinals = need.sparkSession.range(0, min(16**width, rest.count() + taken.count())).withColumnRenamed("id", "ordinal")
    free = numbered(ordinals.join(taken, "ordinal", "left_anti"), ["ordinal"], "free_codes")
    drawn = free.select(F.col("__rank").alias("__at"), (permuted(F.col("ordinal"), width, seed) + 1).alias("pick"))
    served = lookup(rest, drawn, {"__rank": "__at"}, "__rank")
    return served.select(*keys, F.coalesce("pick", F.lit(0).cast("bigint")).alias("pick")).unionByName(kept)
