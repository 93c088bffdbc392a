"""Connected components as Spark jobs: every label hooks to its smallest
neighbour, pointers are halved, and the edges between the labels that are left
go on to the next round.  Edges and labels stay in written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.indexing import write_table


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node that the edges ``a``, ``b`` reach) of every node with an edge."""
    labels, left = None, _tidy(edges.select("a", "b"))
    while True:
        left = write_table(left, "edges")
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select(
            "node", F.least("node", "low").alias("up"))
        up = write_table(_halve(_halve(up)), "pointers")
        labels = up.select("node", F.col("up").alias("component")) if labels is None else labels.join(
            up.select(F.col("node").alias("component"), "up"), "component", "left").select(
                "node", F.coalesce("up", "component").alias("component"))
        to = lambda c: up.select(F.col("node").alias(c), F.col("up").alias("to_" + c))
        left = _tidy(left.join(to("a"), "a").join(to("b"), "b").select(
            F.col("to_a").alias("a"), F.col("to_b").alias("b")))
        if left.isEmpty():
            return write_table(labels, "components")


def _tidy(edges: DataFrame) -> DataFrame:
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()


def _halve(up: DataFrame) -> DataFrame:
    above = up.select(F.col("node").alias("up"), F.col("up").alias("above"))
    return up.join(above, "up", "left").select("node", F.coalesce("above", "up").alias("up"))
