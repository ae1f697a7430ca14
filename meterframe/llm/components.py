"""Connected components of a graph of links, by label propagation in joins.

Each round gives a node the least label among its neighbours and itself, then
the label of that label.  Groups that are stars or cliques settle in two or
three rounds, chains in a number of rounds that grows with the logarithm of
their length.  Labels are written to the shared folder after each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterframe.session import durable


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b): one row per linked node, (node, label), with the least
    node of its component.  Nodes without a link have no row."""
    links = links.select("a", "b").where("a <> b")
    both = durable(links.union(links.select("b", "a")).distinct(), "edges")
    labels = durable(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select("node", F.least("node", "near").alias("label")),
        "labels",
    )
    while True:
        seen = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(seen, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        moved = durable(
            lower.join(jump, "label", "left").select("node", "old", F.least("label", F.coalesce("further", "label")).alias("label")), "labels"
        )
        labels = moved.select("node", "label")
        if moved.where("old <> label").isEmpty():
            return labels
