"""Connected components of an edge list by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stage


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One round. Large star: larger neighbours move to the smallest one. Small star: smaller ones and the node itself do."""
    if large:
        ends = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        ends = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = ends.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    joined = ends.join(least, "u")
    moved = joined.filter(F.col("v") > F.col("u") if large else F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        moved = moved.union(least.select("u", F.col("m").alias("v")))
    return moved.filter(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, root: for every node of ``edges`` (u, v; of any ordered type) the smallest node that it is linked to. Nodes without edges are left out.

    Each round is written to the shared folder, and the one before removed. A round costs two joins of the remaining links;
    a hub's links are counted by partial aggregation and its join can be split by Spark.
    """
    edges = stage(edges.select("u", "v").filter(F.col("u") != F.col("v")).distinct(), "links")
    mark = None
    for _ in range(most_rounds):
        last, edges = edges, stage(_stars(_stars(edges, large=True), large=False), "stars")
        discard(last)
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v"))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
