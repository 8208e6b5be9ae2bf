"""Connected components of a graph whose edges are a table.

Alternating star steps: each node is linked to the smallest node of its neighbourhood until every
component is one star around its smallest member. All steps are aggregations and joins on node ids; a
node with very many neighbours is pre-aggregated before each shuffle, and its join may be split. The
driver sees two numbers per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattgrid.session import discard, staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of each node to the smallest of all."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node (a > b in every edge) and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def labels(edges: DataFrame) -> DataFrame:
    """``node, label`` for each node with an edge: the smallest node of its component. ``edges`` has the
    columns ``a, b``; loops, repeats and either direction are allowed, NULLs are left out."""
    clean = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    stars, before = staged(clean), None
    while before != (now := _state(stars)):
        before = now
        earlier, stars = stars, staged(_small_star(_large_star(stars)))
        discard(earlier)
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(roots)
