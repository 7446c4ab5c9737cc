"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstats.llm.tables import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (u, v: long) that isn't its component's least node.

    Every round is written under the shared folder, so lineage stays short.
    Rounds go on until the edge set stays the same, which takes O(log^2 nodes) of them.
    """
    now = written(edges.select("u", "v").where("u <> v").distinct(), "edges")
    mark = None
    while True:
        now = written(_small_star(_large_star(now)), "edges")
        stamp = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if stamp == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = stamp
