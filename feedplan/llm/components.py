"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedplan.operators.lookup import lookup
from feedplan.sources.staging import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the edges (a, b); root is the least node of its component.

    Each round makes every node point to the least neighbour of its own
    neighbours (large star), and then of those that are smaller (small star). The
    number of rounds grows with the logarithm of the component's size. Sums of the
    edges tell when nothing changes; only those reach the driver.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    pairs, before = staged(pairs, "edges"), None
    while True:
        both = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
        # a node with very many neighbours: the lookup lets its edges be split over tasks
        large = lookup(both, least, {"a": "k"}, "b", how="inner").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "k")
        small = lookup(large, least, {"a": "k"}, "b", how="inner").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        pairs = staged(small.select("e.*").where("a <> b").distinct(), "edges")
        state = tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before = state
    roots = pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
