"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fillscope.scale import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """The smallest node of each node's component: columns node, component.

    ``edges`` has bigint columns a and b without nulls; repeated edges and loops are harmless.
    Labels spread along edges and then jump to their own label, so the
    number of turns grows with the logarithm of a component's diameter in usual graphs. Each turn is stored, and only a
    count of changed labels comes to the driver.
    """
    pairs = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    pairs = cut_lineage(pairs)
    labels = cut_lineage(pairs.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("component")))
    while True:
        seen = pairs.join(labels.select(F.col("node").alias("b"), F.col("component").alias("c")), "b")
        near = seen.groupBy(F.col("a").alias("node")).agg(F.min("c").alias("c"))
        spread = labels.join(near, "node", "left").select(
            "node", F.col("component").alias("old"), F.least("component", F.coalesce("c", "component")).alias("component")
        )
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        stored = cut_lineage(
            spread.join(jump, "component", "left").select(
                "node", "old", F.least("component", F.coalesce("further", "component")).alias("component")
            )
        )
        changed = stored.where("old != component").limit(1).count()
        labels = stored.select("node", "component")
        if not changed:
            return labels
