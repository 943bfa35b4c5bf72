"""Connected components by alternating large and small stars (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skyloom.llm.common import Store


def _sum_of(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest node of its neighbourhood."""
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b")
    return moved.select(F.col("m").alias("a"), "b").union(moved.select("m", "a")).toDF("a", "b").where("a < b").distinct()


def components(edges: DataFrame, store: Store) -> DataFrame:
    """(node, root): for every node of an edge, the smallest node reachable.

    ``edges`` holds two columns of one orderable type; loops, repeats and either direction may occur,
    rows with a null end are ignored. No step gathers a neighbourhood: minima are partial aggregates, and a
    node with very many neighbours is a skewed join key that Spark splits. Rounds grow with the
    logarithm of the longest path; each is stored, so a lost executor repeats one round at most.
    """
    edges = edges.toDF("x", "y").where("x is not null and y is not null and x <> y")
    edges = edges.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    edges, before = store.keep(edges), None
    while (now := _sum_of(edges)) != before:
        before = now
        if not now[0]:
            break
        wider = store.keep(_large(edges))
        closer = store.keep(_small(wider))
        store.drop(edges, wider)
        edges = closer
    roots = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.union(roots.select(F.col("root"), "root").distinct())
