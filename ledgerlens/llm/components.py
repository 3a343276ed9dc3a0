"""Connected components of an edge table by alternating large and small stars.

Each round is made of aggregates and joins on the node (a hub's edges are never gathered in
one group) and is written to the shared folder; the rounds end when all edges form stars.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    hung = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def _tangled(edges: DataFrame) -> DataFrame:
    """Nodes that hang on two others, or on one while others hang on them: none if all are stars."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR (up = 1 AND down = 1)")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (u, v); the root is the smallest node of the component.

    A node without edges, or with an edge to itself only, has no row.
    """
    now, before = edges.select("u", "v").where("u <> v"), None
    while True:
        now = materialize(_small_star(_large_star(now)), "stars")
        if before is not None:
            discard(before)
        before = now
        if _tangled(now).isEmpty():
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
