"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelake.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(a, b) links -> (node, label): every linked node with the smallest node of its component.

    Each round joins all nodes to smaller ones of their neighbourhood and is
    written to the shared folder; rounds grow with the logarithm of the
    longest chain.  A node with very many links is one key of a join whose
    other side has one row per node, so a skewed key is split.  Null ends and
    loops are dropped; no links give no rows.
    """
    edges = (links.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
             .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    edges, mark = stored(edges, "links"), None
    while True:
        now = edges.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
        mark = tuple(now)
        both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(
            edges.select(F.col("v").alias("x"), F.col("u").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select(F.col("x").alias("node"), F.least("x", "m").alias("m"))
        large = (both.join(least, both["x"] == least["node"]).filter("y > x")
                 .select(F.col("y").alias("u"), F.col("m").alias("v")).distinct())
        small = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), "m")
        step = (large.join(small, large["u"] == small["node"]).filter("v <> m")
                .select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = stored(step.unionByName(small.select(F.col("node").alias("u"), F.col("m").alias("v"))).distinct(), "links")
