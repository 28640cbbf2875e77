"""Connected components of a link table, without ever holding links or labels on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.scratch import Scratch


ROWS_A_PART = 200_000


def components(links: DataFrame, scratch: Scratch, tag: str) -> DataFrame:
    """``links(a, b)`` to ``(node, label)``: the smallest node of each component, for every linked node.

    Each round takes the smallest label among a node and its neighbours and then jumps to that label's own,
    so rounds grow with the logarithm of a component's width. Links and labels are written between rounds.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct()
    both = scratch.save(both, f"{tag}-links")
    parts = 4 + both.count() // ROWS_A_PART  # links are few beside the texts they join: fewer partitions than a shuffle of texts has
    labels = scratch.save(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")).coalesce(parts), f"{tag}-labels0")
    step = 0
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("near")), "b").groupBy("a").agg(F.min("near").alias("near"))
        lower = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        # The label of a node's label, from the round before: as old labels only fall, taking it early is right too.
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        after = lower.join(jump, "label", "left").select("node", "old", F.least("label", F.coalesce("further", "label")).alias("label"))
        step += 1
        after = scratch.save(after.coalesce(parts), f"{tag}-labels{step}")
        if not after.filter("label <> old").count():
            return after.select("node", "label")
        labels = after.select("node", "label")
