"""Connected components by alternating stars over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from parceltide.llm import common

MOST_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links(a, b)``; the component is its smallest node.

    Each round links a node's larger neighbours to its smallest one, then its smaller neighbours,
    until every component is a star around its smallest node. Rounds are written out, so neither the
    lineage nor a task grows with the size of a component.
    """
    edges = common.written(_distinct(links.select("a", "b")), "links")
    for _ in range(MOST_ROUNDS):
        if _are_stars(edges):
            break
        edges = common.written(_small_star(_large_star(edges)), "links")
    else:
        raise RuntimeError(f"links did not settle in {MOST_ROUNDS} rounds")
    # Every edge now leads from a node to the smallest of its component.
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _are_stars(edges: DataFrame) -> bool:
    """Whether every larger node has one edge and is no smaller node of another."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("child")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("child")))
    counts = ends.groupBy("node").agg(F.sum("child").alias("above"), F.count("*").alias("all"))
    return not counts.filter("above > 1 OR (above = 1 AND all > 1)").head(1)


def _distinct(edges: DataFrame) -> DataFrame:
    """Edges from the larger to the smaller node, once each."""
    return edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return _distinct(both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _distinct(moved.unionByName(least.select("a", F.col("m").alias("b"))))
