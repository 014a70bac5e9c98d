"""Connected components of a link table, by smallest labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelens.llm.shared import materialise


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b): the smallest node
    that links reach. Each round takes the smallest label among a node and its
    neighbours and then the label of that label, so a path of n links is done
    in about log2(n) rounds; labels and links stay distributed, and each round
    is written to the shared folder. An empty link table gives no rows."""
    both = links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct()
    edges = materialise(both, "edges")
    label = materialise(
        edges.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("component")), "label"
    )
    while True:
        near = edges.join(label, edges.b == label.node).groupBy("a").agg(F.min("component").alias("low"))
        lower = label.join(near, label.node == near.a, "left").select(
            "node", "component", F.least("component", "low").alias("low")
        )
        up = label.select(F.col("node").alias("low"), F.col("component").alias("top"))
        step = lower.join(up, "low", "left").select(
            "node", F.least("low", "top").alias("component"), (F.least("low", "top") < F.col("component")).alias("changed")
        )
        step = materialise(step, "label")
        label = step.select("node", "component")
        if step.where("changed").isEmpty():
            return label
