"""Connected components of a graph that only Spark holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracelake.llm.common import store


def smallest_reachable(edges: DataFrame, first: DataFrame) -> DataFrame:
    """node, component, root: for each node of an edge the smallest ``first`` that can be reached, and
    the node that has it.

    ``edges``: a long, b long, undirected. ``first``: node long, first long, one row per node.

    Each node's label is the smallest (first, node) seen so far. A round takes the labels of
    neighbours and then the label of the label's own node, which halves the way to the end of
    a chain. Rounds go on until no label changes. Every table is stored, so the joins have a
    plain shuffle on both sides and adaptive execution can split a label that a large
    component shares.
    """
    both = store(edges.filter("a <> b").select("a", "b").union(edges.filter("a <> b").select("b", "a")).distinct(),
                 "edges").toDF("node", "other")
    nodes = both.select("node").distinct()
    labels = store(nodes.join(first, "node").select(
        "node", F.struct(F.col("first").alias("first"), F.col("node").alias("at")).alias("label")), "labels")
    while True:
        seen = both.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(
            F.min("label").alias("seen"))
        nearer = store(labels.join(seen, "node").select(
            "node", F.least("label", "seen").alias("label"), (F.col("seen") < F.col("label")).alias("moved")), "nearer")
        if nearer.filter("moved").isEmpty():
            return labels.select("node", F.col("label.first").alias("component"), F.col("label.at").alias("root"))
        ahead = nearer.select(F.col("node").alias("at"), F.col("label").alias("ahead"))
        labels = store(
            nearer.withColumn("at", F.col("label.at")).join(ahead, "at")
            .select("node", F.least("label", "ahead").alias("label")), "labels")
