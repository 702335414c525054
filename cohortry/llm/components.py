"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortry.operators import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a, b``, longs); nodes of a component share a root.

    Every node hooks onto its neighbour of least hash, edges are moved to the hooks, and loops and
    repeats go, until no edge is left.  Hash order makes a path shrink by a constant share each round.
    Each round is a stored table; nothing of the graph is collected.
    """
    def order(c):
        return F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("id"))
    edges = materialise(edges.select("a", "b").where("a <> b"))
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = nodes.withColumn("root", F.col("node"))
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        hook = materialise(both.groupBy("a").agg(F.min(order("b")).alias("m")).select(
            F.col("a").alias("n"),
            F.when(F.col("m.h") < F.xxhash64("a"), F.col("m.id")).otherwise(F.col("a")).alias("to")))
        labels = materialise(labels.join(hook, F.col("root") == F.col("n"), "left").select(
            "node", F.coalesce("to", "root").alias("root")))
        edges = materialise(
            edges.join(hook, F.col("a") == F.col("n")).select(F.col("to").alias("a"), "b")
            .join(hook, F.col("b") == F.col("n")).select("a", F.col("to").alias("b"))
            .where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .distinct())
    return labels
