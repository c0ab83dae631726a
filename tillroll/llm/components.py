"""Connected components of a graph that lies in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import land


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, label: the smallest node that can be reached, for every node of a link.

    Labels go to neighbours and then to the label's own label, so the rounds
    needed grow with the logarithm of a component's diameter. Each round is
    written out; only the number of changed labels comes to the driver.
    Without links the result is empty.
    """
    edges = land(links.select(F.col(a).alias("node"), F.col(b).alias("other"))
                 .union(links.select(F.col(b), F.col(a))).distinct(), "edges")
    labels = land(edges.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("label")), "labels")
    while True:
        near = (edges.join(labels.withColumnRenamed("node", "other"), "other")
                .groupBy("node").agg(F.min("label").alias("seen")))
        mine = labels.join(near, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "seen").alias("label"))
        mine = land(mine, "labels")
        up = mine.select(F.col("node").alias("label"), F.col("label").alias("higher"))
        # a label is itself a node: its own label is at most as large
        new = land(mine.join(up, "label").select("node", "old", F.col("higher").alias("label")), "labels")
        if not new.where(F.col("old") != F.col("label")).limit(1).count():
            return new.select("node", "label")
        labels = new.select("node", "label")
