"""Connected components of links by alternating stars: no group is collected, each round is two aggregates and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.llm.common import keep


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    under = down.join(least, "u").where(F.col("v") > F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return under.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``key, component``: the smallest key reachable, for each key that has a link to another."""
    edges = keep(links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct(), "edges")
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == seen or not state[0]:
            return edges.select(F.col("u").alias("key"), F.col("v").alias("component")).union(
                edges.select(F.col("v").alias("key"), F.col("v").alias("component")).distinct())
        seen = state
        edges = keep(_small_star(_large_star(edges)), "edges")
