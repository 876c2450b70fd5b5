"""Connected components of a stored link table, without collecting links or nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (u, v); component is the smallest node reachable.

    Each round gives a node the smallest label among itself and its neighbours, then the label of
    that label (pointer jumping). Labels are written to the shared folder each round, so lineage
    stays short; neighbours are pre-aggregated before the shuffle, so hubs stay spread.
    """
    both = stored(links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
                  .filter("u <> v").distinct(), "links")
    labels = stored(both.groupBy("u").agg(F.min("v").alias("v")).select(
        F.col("u").alias("node"), F.least("u", "v").alias("component")), "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("v"), "component"), "v")
                .groupBy("u").agg(F.min("component").alias("__near")))
        step = labels.join(near, labels["node"] == near["u"]).select(
            "node", F.col("component").alias("__old"), F.least("component", "__near").alias("__new"))
        jump = labels.select(F.col("node").alias("__at"), F.col("component").alias("__far"))
        step = stored(step.join(jump, F.col("__new") == F.col("__at"), "left").select(
            "node", "__old", F.least("__new", F.coalesce("__far", "__new")).alias("component")), "labels")
        labels = step.select("node", "component")
        if step.filter("component <> __old").isEmpty():
            return labels
