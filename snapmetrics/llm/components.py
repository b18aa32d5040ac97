"""Connected components by alternating large-star and small-star steps over a written edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmetrics.llm.common import drop_stored, stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node points its larger neighbours at the smallest node of its neighbourhood (itself included). Edges run from
    larger (a) to smaller (b), before and after."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node points itself and its smaller neighbours at the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _all_stars(edges: DataFrame) -> bool:
    """True if every node with an edge to a smaller one has exactly one, and nobody points at such a node."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("centre"))
    ends = ends.unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("centre")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("centre").alias("centre")).filter("up + centre > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: bigint, any direction, repeats allowed) -> (node, component): the smallest node reachable.

    Nodes without an edge to another node are not listed; null ends are ignored. Each round's edges are written to the
    shared folder, so the plan stays two joins deep and a lost executor costs one round at most.
    """
    now = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = stored(now, "star")
    while not _all_stars(now):
        then = now
        now = stored(_small_star(_large_star(then)), "star")
        drop_stored(then)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
