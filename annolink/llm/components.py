"""Connected components of a table of edges, by alternating large-star and small-star steps.

Each step is a minimum per vertex and a join back, so no list of neighbours is gathered. The
rows of a hot vertex are merged before the shuffle of the minimum, and split in the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolink.staging import stage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    moved = both.join(least.withColumnRenamed("u", "c"), F.col("u") == F.col("c"))
    return moved.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least.withColumnRenamed("u", "c"), F.col("u") == F.col("c"))
    pairs = moved.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m"))
    return pairs.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(vertex, root) for all vertices of edges (a, b); the root is the smallest reachable vertex."""
    def state(rows: DataFrame) -> tuple:
        return tuple(rows.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = stage(edges.where(F.col("a") != F.col("b")).distinct())
    seen = None
    while True:
        edges = stage(_small_star(_large_star(edges)))
        now = state(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select("b").distinct().select(F.col("b").alias("vertex"), F.col("b").alias("root"))
    return edges.select(F.col("a").alias("vertex"), F.col("b").alias("root")).union(roots)
