"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.tables import set_down
from riskloom.operators.joins import own_shuffle


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of edges (a, b): the label is the smallest node of its component.

    Each round takes the smallest label among the neighbours and then the label of that label, so that paths halve.
    Rounds are written to the shared folder, and the loop ends with the first that changes nothing.
    """
    edges = edges.select("a", "b").where("a <> b").distinct()
    both = set_down(edges.union(edges.select("b", "a")), "edges")
    state = set_down(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("label")), "labels")
    while True:
        known = state.select(F.col("node").alias("b"), "label")
        near = both.join(known, "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = state.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = state.select(F.col("node").alias("label"), F.col("label").alias("next"))
        lower = lower.join(own_shuffle(jump, "label"), "label").select("node", "old", F.least("label", "next").alias("label"))
        after = set_down(lower, "labels")
        if after.where("old <> label").isEmpty():
            return after.select("node", "label")
        state = after.select("node", "label")
