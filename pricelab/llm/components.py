"""Connected components of an edge table by minimum labels, hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelab.llm.frames import discard, written


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) to (node, label): the smallest node reachable. Nodes without edges are not returned.

    Every round takes the smallest label next to a node, hands it to the node's old
    label and then jumps to the label's label, so long chains take few rounds.
    """
    both = edges.select(F.col("u").alias("a"), F.col("v").alias("b"))
    both = written(both.unionAll(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    total = None
    while True:
        now = labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
        if now == total:
            discard(both)
            return labels
        total = now
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels["node"] == near["a"]).select("node", "label", F.least("label", "near").alias("new"))
        offers = step.select("node", "new").unionAll(step.where("new < label").select(F.col("label").alias("node"), "new"))
        best = offers.groupBy("node").agg(F.min("new").alias("label"))
        up = best.select(F.col("node").alias("at"), F.col("label").alias("above"))
        before, labels = labels, written(best.join(up, best["label"] == up["at"]).select("node", F.col("above").alias("label")), "labels")
        discard(before)
