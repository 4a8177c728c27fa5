"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.stored import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); the component is its smallest node.

    Labels pass to neighbours and then jump to the label's own label, so long chains take
    logarithmically many rounds. Every round combines a node's messages before it shuffles them.
    """
    both = stored(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "component_links")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("component")), "component_labels")
    while True:
        heard = (
            both.join(labels.select(F.col("node").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("heard"))
        )
        nearer = labels.join(heard, "node").select("node", F.col("component").alias("old"), F.least("component", "heard").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("component").alias("beyond"))
        new = stored(nearer.join(jump, "next").select("node", F.least("next", "beyond").alias("component"), "old"), "component_labels")
        labels = new.select("node", "component")
        if new.where(F.col("component") != F.col("old")).isEmpty():
            return labels
