"""Connected components of a link table, by Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalloom.sources.scratch import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b); the label is the smallest node of its component.

    Each round takes the smallest label among neighbours, then the label of that
    label, so long chains shrink quickly.  Sums before the shuffle keep a node
    with very many links from being hot.  Rounds are written out: none depends
    on the lineage of those before.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialize(both.where("a <> b").distinct(), "links")
    labels = materialize(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels"
    )
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node"))
        moved = labels.join(near.agg(F.min("label").alias("near")), "node")
        moved = moved.select("node", F.least("label", "near").alias("next"), F.col("label").alias("before"))
        above = labels.select(F.col("node").alias("next"), F.col("label").alias("above"))
        jumped = moved.join(above, "next", "left").select(
            "node", F.least("next", F.coalesce("above", "next")).alias("label"), "before"
        )
        labels = materialize(jumped, "labels")
        if labels.where("label <> before").limit(1).count() == 0:
            return labels.select("node", "label")
