"""Connected components of a graph held in a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import drop_kept, keep


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the least node of each node's component, for all nodes of the edges.

    Each round gives every node the least label among its neighbours, then follows labels once
    (label of label), so path lengths shrink by half at least. Rounds are written to the shared folder;
    nothing but the number of changed labels reaches the driver. An empty graph gives no rows.
    """
    both = keep(edges.select(F.col(a).alias("node"), F.col(b).alias("other"))
                .union(edges.select(F.col(b).alias("node"), F.col(a).alias("other"))).distinct())
    labels = keep(both.groupBy("node").agg(F.least("node", F.min("other")).alias("root")))
    while True:
        seen = both.join(labels.select(F.col("node").alias("other"), F.col("root").alias("near")), "other") \
            .groupBy("node").agg(F.min("near").alias("near"))
        lowered = labels.join(seen, "node").select(
            "node", F.col("root").alias("before"), F.least("root", "near").alias("root"))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("further"))
        after = keep(lowered.join(jump, "root").select(
            "node", F.least("root", "further").alias("root"), F.col("before")))
        changed = after.where(F.col("root") != F.col("before")).limit(1).count()
        drop_kept(labels)
        labels = after.select("node", "root")
        if not changed:
            return labels
