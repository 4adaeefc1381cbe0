"""Connected components of a table of links, by large-star and small-star rounds.

Each round is two aggregates and two joins over the links; hot nodes are
aggregated before they are shuffled. Every round is a written table, so no
lineage grows and nothing passes the driver but two sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import drop, written


def components(links: DataFrame, label: str = "links", most_rounds: int = 100) -> DataFrame:
    """(node, component): every node of ``links`` (a, b) with the smallest node that it reaches."""
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    sign = signature(edges)
    for _ in range(most_rounds):
        if not sign[0]:
            break
        nxt = written(small_star(large_star(edges)), label)
        drop(edges)
        edges, before = nxt, sign
        sign = signature(edges)
        if sign == before:
            break
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select("b", "b").distinct())


def signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked with the smallest of the node and its neighbours."""
    both = edges.union(edges.select("b", "a"))  # (node, neighbour)
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    return both.join(least, both.a == least.u).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked with the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
    joined = edges.join(least, edges.a == least.u)
    return joined.select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").where("a > b").distinct()
