"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.storage import materialize


def _rounds_of(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star round over edges (u > v)."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    joined = large.join(least, "u")
    small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", F.col("m").alias("v")))
    return small.filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the undirected ``edges`` (a, b); the root is the smallest node of the component.

    Every round is stored in the shared folder. Chains shorten by half or more with each round, stars are done at once,
    and a node with very many edges only ever takes part in sums and splittable joins. Null ends are ignored.
    """
    oriented = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = materialize(oriented.distinct(), "edges")
    while True:
        # Done when every node has one edge to a smaller one and no such smaller node has one itself.
        ends = now.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
        ends = ends.union(now.select("v", F.lit(0), F.lit(1))).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if ends.filter("up > 1 OR (up = 1 AND down = 1)").isEmpty():
            roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return roots.union(now.select(F.col("v"), F.col("v"))).distinct()
        now = materialize(_rounds_of(now), "edges")
