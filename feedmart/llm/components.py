"""Connected components of a graph given by its edges, with Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmart.llm.common import settle


_EDGES_PER_TASK = 500_000


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b): the smallest node that can be reached.

    Alternates two steps until only stars are left: every node links its larger
    neighbours to the smallest one it knows, then its smaller ones. Edges shrink
    to stars around the smallest node in a number of rounds that grows with the
    logarithm of the longest path. A node with very many edges is reduced to its
    minimum before the shuffle; the joins back can be split by adaptive
    execution. Each round is a table in the shared folder.
    """
    stars = settle(_oriented(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))), "edges")
    parts = 8 + stars.count() // _EDGES_PER_TASK  # edges only become fewer
    while not _only_stars(stars):
        stars = settle(_small_star(_large_star(stars)), "edges", parts)
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _only_stars(edges: DataFrame) -> bool:
    """Whether every node is either a centre or has one edge, to a centre. Edges go from larger nodes to smaller ones."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("leaf"), F.lit(0).alias("centre")).unionByName(
        edges.select(F.col("v").alias("n"), F.lit(0).alias("leaf"), F.lit(1).alias("centre"))
    )
    both = ends.groupBy("n").agg(F.sum("leaf").alias("leaf"), F.max("centre").alias("centre")).where("leaf + centre > 1")
    return both.isEmpty()


def _oriented(edges: DataFrame) -> DataFrame:
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    down = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return down.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
