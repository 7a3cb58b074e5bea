"""Connected components by contraction, in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobloom.llm.common import forget, written


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node in edges (a, b): label is the smallest node
    of its component. Edges may repeat, be loops and be in any direction.

    A round gives each node its smallest neighbour as parent and follows parents
    to the roots, halving the way each time; edges then join roots. At least half
    of the roots vanish in a round. Nothing is collected."""
    edges, labels = written(edges.filter("a <> b").select("a", "b").distinct(), "edges"), None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("label")), "parents")
        while True:
            above = parent.select(F.col("node").alias("label"), F.col("label").alias("above"))
            parent, older = written(parent.join(above, "label").select("node", "above", (F.col("above") != F.col("label")).alias("moved")), "parents"), parent
            forget(older)
            still = parent.filter("moved").isEmpty()
            parent = parent.select("node", F.col("above").alias("label"))
            if still:
                break
        if labels is None:
            labels = parent
        else:
            up = parent.select(F.col("node").alias("label"), F.col("label").alias("up"))
            labels = written(labels.join(up, "label", "left").select("node", F.coalesce("up", "label").alias("label")), "labels")
        la = parent.select(F.col("node").alias("a"), F.col("label").alias("la"))
        lb = parent.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        roots = edges.join(la, "a").join(lb, "b").filter("la <> lb").select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).distinct()
        edges, older = written(roots, "edges"), edges
        forget(older)
        if edges.isEmpty():
            return labels
