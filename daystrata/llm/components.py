"""Connected components of a large graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daystrata.llm.common import keep


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (left, right): the smallest node it can reach.

    Labels go along the links and then to the label's own label, so paths halve each round. Minima are taken with
    partial aggregates, so a node may have any number of links. Each round is written to the shared folder.
    """
    both = links.select("left", "right").unionByName(links.select(F.col("right").alias("left"), F.col("left").alias("right")))
    both = keep(both.filter("left <> right"))
    labels = keep(
        both.groupBy("left").agg(F.min("right").alias("least")).select(F.col("left").alias("node"), F.least("left", "least").alias("component"))
    )
    while True:
        of_right = labels.select(F.col("node").alias("right"), F.col("component").alias("offer"))
        offers = both.join(of_right, "right").groupBy(F.col("left").alias("node")).agg(F.min("offer").alias("offer"))
        better = labels.join(offers, "node").select("node", "component", F.least("component", "offer").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("component").alias("beyond"))
        moved = keep(better.join(jump, "next").select("node", F.least("next", "beyond").alias("component"), F.col("component").alias("before")))
        labels = moved.select("node", "component")
        if moved.filter("component <> before").isEmpty():
            return labels
