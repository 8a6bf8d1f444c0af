"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marquee.llm.common import stage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): the smallest node reachable, for every node with a link.

    Each round takes the smallest label among a node and its neighbours, then the label of that
    label, until nothing changes; every round is written to the shared folder.
    """
    both = links.select(F.col(a).alias("u"), F.col(b).alias("v")).union(links.select(F.col(b), F.col(a))).where("u <> v").distinct()
    edges = stage(both, "links")
    labels = stage(edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("label")), "labels")
    while True:
        near = edges.join(labels.withColumnRenamed("node", "v"), "v").groupBy("u").agg(F.min("label").alias("near"))
        step = labels.join(near, labels["node"] == near["u"]).select("node", F.col("label").alias("old"), F.least("label", "near").alias("new"))
        jump = labels.select(F.col("node").alias("new"), F.col("label").alias("far"))
        after = stage(step.join(jump, "new", "left").select("node", "old", F.least("new", F.coalesce("far", "new")).alias("label")), "labels")
        labels = after.select("node", "label")
        if after.where("old <> label").isEmpty():
            return labels
