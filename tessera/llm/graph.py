"""Connected components of an edge list, by alternating large and small
stars: every step is a grouped minimum and an equi join, so hubs are combined
map-side and skewed joins are split; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut


def _stars(e: DataFrame) -> bool:
    """Whether distinct edges (u > v) are stars around their smallest node: no
    node has two smaller neighbours, or both a smaller and a larger one."""
    ends = F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                             F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))))
    return e.select(ends.alias("e")).groupBy("e.node").agg(F.sum("e.up").alias("up"), F.max("e.down").alias("down")) \
        .where("up > 1 OR up = 1 AND down = 1").count() == 0


def components(edges: DataFrame) -> DataFrame:
    """(a, b) long pairs -> (node, component), component the smallest node
    reachable.  Nodes without edges do not appear; loops and repeated edges
    are harmless; an empty edge list gives an empty result."""
    e = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
            .distinct(), "stars")
    while not _stars(e):
        # Large star: every larger neighbour of u moves to u's smallest one.
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        big = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .where("u <> v").distinct()
        # Small star: the smaller neighbours of u move to the smallest one.
        low = big.groupBy("u").agg(F.min("v").alias("m"))
        small = big.join(low, "u").select(F.explode(F.array(
            F.struct("u", F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*") \
            .where("u <> v").distinct()
        e = cut(small, "stars")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")) \
        .union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
