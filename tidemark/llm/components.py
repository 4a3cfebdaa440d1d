"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``rep``, the smallest node of its component, for every end of an edge (``a``, ``b``).

    Each round lets every remaining node follow its smallest neighbour, shortens the
    chains to their ends by pointer jumping and contracts the graph. A round at least
    halves the nodes, a jump the chains, so both grow with the logarithm of the size. Aggregates are combined before the
    shuffle, and each join has one row per key on one side, so a node with many
    neighbours is no burden. What a round leaves is written to the shared folder.
    """
    edges = materialize(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges")
    nodes = materialize(edges.select("a").union(edges.select("b")).distinct().select(F.col("a").alias("node"), F.col("a").alias("rep")), "nodes")
    while not edges.isEmpty():
        follow = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("up"))
        jumping = True
        while jumping:
            above = follow.select(F.col("node").alias("up"), F.col("up").alias("top"))
            jumped = follow.join(above, "up", "left").select("node", F.coalesce("top", "up").alias("up"), F.col("top").isNotNull().alias("moved"))
            jumped = materialize(jumped, "follow")
            jumping, follow = not jumped.where("moved").isEmpty(), jumped.drop("moved")
        nodes = materialize(
            nodes.join(follow.withColumnRenamed("node", "rep"), "rep", "left").select("node", F.coalesce("up", "rep").alias("rep")), "nodes"
        )
        for end in ("a", "b"):
            edges = edges.join(follow.withColumnRenamed("node", end), end, "left").withColumn(end, F.coalesce("up", end)).drop("up")
        edges = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
        edges = materialize(edges, "edges")
    return nodes
