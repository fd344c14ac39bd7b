"""Connected components of links by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordops.llm.base import settle


def components(links: DataFrame) -> DataFrame:
    """Smallest node reachable for every node of the links (columns a, b): node, component.

    Each round takes the smallest label among a node's neighbours and then the label of
    that label, so paths shorten as in pointer jumping; a round is an aggregate and joins
    that split at hot labels, and its result is stored. Empty links give no rows.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = settle(both, "links")
    labels = settle(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("low"))
        ahead = labels.select(F.col("node").alias("low"), F.col("label").alias("jump"))
        after = lower.join(ahead, "low", "left").select("node", F.col("label").alias("was"), F.least("low", F.coalesce("jump", "low")).alias("label"))
        after = settle(after, "labels")
        changed = after.filter("label <> was").limit(1).count()
        labels = after.select("node", "label")
        if not changed:
            return labels.withColumnRenamed("label", "component")
