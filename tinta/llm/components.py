"""Connected components of a table of links, by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tinta.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``a, b``; the label is the smallest node that can be reached.

    Each round takes the smallest label among the neighbours and then the label of that label. Labels only fall, and a
    round without a change ends the work; minima are combined per task before they are shuffled.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    both = cut_lineage(both)
    labels = cut_lineage(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")))
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("m"))
        lower = labels.join(near, labels["node"] == near["a"]).select("node", "label", F.least("label", "m").alias("m"))
        target = labels.select(F.col("node").alias("t"), F.col("label").alias("t_label"))
        jumped = lower.join(target, lower["m"] == target["t"], "left").select(
            "node", F.least("m", F.coalesce("t_label", "m")).alias("label"), (F.least("m", F.coalesce("t_label", "m")) < F.col("label")).alias("moved")
        )
        jumped = cut_lineage(jumped)
        labels = jumped.drop("moved")
        if not jumped.where("moved").limit(1).count():
            return labels
