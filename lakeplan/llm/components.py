"""Connected components of a distributed edge list by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeplan.llm import common

MOST_ROUNDS = 60


def large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours are hung on the smallest node of its neighbourhood."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("least"))
    hung = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.least("u", "least").alias("v"))
    return hung.distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are hung on the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    hung = edges.join(least, "u").filter("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return hung.unionByName(least.select("u", F.col("least").alias("v"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable from each node that has an edge to another."""
    current = common.written(edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    before = None
    for _ in range(MOST_ROUNDS):
        state = current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1_000_003)))).first()
        if state == before:
            break
        before = state
        current = common.written(small_star(large_star(current)), "stars")
    else:
        raise RuntimeError("components did not settle")
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
