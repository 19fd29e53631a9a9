"""Connected components of an undirected graph, distributed: nothing is collected but one count per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import release
from tidemark.session import stage


def components(links: DataFrame) -> DataFrame:
    """(node, label): the least node that each node of ``links`` (a, b) reaches; nodes are longs.

    Each round every node takes the least label around it, and then that label's own label, so a chain's length
    shrinks by at least half a round. Labels are written once per round to the shared folder, which cuts the lineage.
    A node with very many links is only a hot key of a minimum, which is combined map-side.
    """
    both = links.select("a", "b").union(links.select("b", "a")).filter("a != b").distinct()
    edges = stage(both)
    labels = stage(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")))
    while True:
        near = edges.join(labels, F.col("b") == F.col("node")).select(F.col("a").alias("node"), "label")
        least = near.union(labels.select("node", "label")).groupBy("node").agg(F.min("label").alias("label"))
        own = labels.select(F.col("node").alias("label_node"), F.col("label").alias("label_label"))
        jumped = least.join(own, F.col("label") == F.col("label_node"), "left")
        jumped = jumped.select("node", F.least("label", F.coalesce("label_label", "label")).alias("label"))
        old = labels.select("node", F.col("label").alias("old"))
        new = stage(jumped.join(old, "node"))
        changed = new.filter("label != old").limit(1).count()
        labels = new.select("node", "label")
        if not changed:
            return labels
        release(links.sparkSession)
