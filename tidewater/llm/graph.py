"""Connected components of a link table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) -> (node, label): the smallest node reachable, for
    every node that has a link.

    Every node takes the smallest label next to it, and that one's; then links
    are redrawn between labels, which leaves few of them, until none is left."""
    def drawn(pairs: DataFrame) -> DataFrame:
        return materialise(pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")

    edges, labels = drawn(links), None
    while labels is None or not edges.isEmpty():
        ends = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
        next_to = ends.groupBy(F.col("e.a").alias("node")).agg(F.min("e.b").alias("low"))
        hop = next_to.select("node", F.least("node", "low").alias("label"))
        jump = hop.select(F.col("node").alias("label"), F.col("label").alias("far"))
        hop = materialise(hop.join(jump, "label", "left").select("node", F.coalesce("far", "label").alias("label")), "hop")
        if labels is None:
            labels = hop
        else:
            to = hop.select(F.col("node").alias("label"), F.col("label").alias("to"))
            labels = materialise(labels.join(to, "label", "left").select("node", F.coalesce("to", "label").alias("label")), "labels")
        edges = drawn(edges.join(hop.toDF("a", "la"), "a").join(hop.toDF("b", "lb"), "b").select(
            F.col("la").alias("a"), F.col("lb").alias("b")))
    return labels
