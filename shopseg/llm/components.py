"""Connected components of an edge table, by alternating large-star and small-star steps.

The number of rounds grows with the logarithm of the longest chain; each round is two aggregations and
joins over the edges, and its result is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopseg.llm import shared


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` (a, b) with a > b. Large: each node's larger neighbours move to its smallest one. Small: the
    smaller ones and the node itself do."""
    near = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        near = near.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = near.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    moved = near.join(least, "u")
    if large:
        moved = moved.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = moved.select(F.col("v").alias("a"), F.col("m").alias("b")) \
            .unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``edges`` (columns a, b of one orderable type); root: the smallest node."""
    now = shared.written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                         .where("a <> b").distinct(), "edges")
    seen = None
    while True:
        digest = now.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first()
        if digest == seen:
            break
        seen = digest
        now = shared.written(_star(shared.written(_star(now, True), "edges"), False), "edges")
    children = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return children.unionByName(children.select(F.col("root").alias("node"), "root").distinct())
