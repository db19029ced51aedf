"""Connected components by repeated contraction, all in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(edges: DataFrame) -> DataFrame:
    """``(a, b)`` links -> one row ``(node, component)`` per linked node; component = smallest node.

    Each round gives the nodes fresh hash priorities, replaces every node by
    the neighbour (or itself) of least priority and drops the loops, so the
    edge set shrinks by a constant factor per round whatever its shape (hub or
    chain). Neighbour minima are combined before the shuffle; a hub's edges
    meet only in joins that AQE may split.
    """
    edges = cut(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("label", F.col("node"))
    turn = 0
    while not edges.isEmpty():
        def rank(c, turn=turn):
            return F.xxhash64(F.lit(turn), F.col(c))

        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        best = both.groupBy("u").agg(F.min(F.struct(rank("v").alias("r"), F.col("v"))).alias("best"))
        moves = cut(best.where(F.col("best.r") < rank("u")).select("u", F.col("best.v").alias("to")))
        for side in ("a", "b"):
            edges = edges.join(moves.withColumnRenamed("u", side), side, "left").withColumn(
                side, F.coalesce("to", side)).drop("to")
        edges = cut(edges.where("a <> b").select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        labels = labels.join(moves.withColumnRenamed("u", "label"), "label", "left").select(
            "node", F.coalesce("to", "label").alias("label"))
        turn += 1
    labels = cut(labels)
    least = labels.groupBy("label").agg(F.min("node").alias("component"))
    return labels.join(least, "label").select("node", "component")
