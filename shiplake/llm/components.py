"""Connected components of an edge table, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shiplake.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """node, component (least node) for every node of ``a``, ``b``. Each round takes the least label around a node and
    then the label of that label; minima combine before the shuffle, so a hub costs no more than any node."""
    both = stage(
        edges.select(F.col("a").alias("node"), F.col("b").alias("near"))
        .unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("near"))).distinct(), "links")
    labels = stage(both.groupBy("node").agg(F.min("near").alias("m")).select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        around = (
            both.join(labels.withColumnRenamed("node", "near"), "near").groupBy("node").agg(F.min("label").alias("m"))
        )
        nearer = labels.join(around, "node").select("node", "label", F.least("label", "m").alias("new"))
        # roots named by an old label move with it
        moved = nearer.groupBy(F.col("label").alias("old")).agg(F.min("new").alias("to"))
        step = nearer.join(moved, nearer["new"] == moved["old"], "left").select(
            "node", "label", F.least("new", F.coalesce("to", "new")).alias("new"))
        step = stage(step, "labels")
        labels_next = step.select("node", F.col("new").alias("label"))
        if step.where("new != label").isEmpty():
            return labels_next.withColumnRenamed("label", "component")
        labels = labels_next
