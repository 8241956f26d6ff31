"""Connected components of a table of links, by joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.llm.frames import cut


def components(links: DataFrame, one: str = "x", two: str = "y") -> DataFrame:
    """``(node, comp)`` for every linked node; ``comp`` is the smallest node it can reach.

    Every round takes the smallest label among a node's neighbours, then follows labels to their
    own labels, so that long chains shorten by more than half."""
    pairs = links.select(F.col(one).alias("node"), F.col(two).alias("other"))
    edges = cut(
        pairs.unionByName(pairs.select(F.col("other").alias("node"), F.col("node").alias("other")))
        .filter("node != other")
        .distinct()
    )
    labels = edges.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("comp"))
    labels = cut(labels)
    while True:
        near = edges.join(
            labels.select(F.col("node").alias("other"), F.col("comp").alias("near")), "other"
        )
        best = near.groupBy("node").agg(F.min("near").alias("near"))
        hooked = labels.join(best, "node").select(
            "node", "comp", F.least("comp", "near").alias("next")
        )
        jump = labels.select(F.col("node").alias("next"), F.col("comp").alias("further"))
        moved = cut(
            hooked.join(jump, "next").select(
                "node", F.least("next", "further").alias("comp"), F.col("comp").alias("before")
            )
        )
        labels = moved.select("node", "comp")
        if moved.filter("comp != before").isEmpty():
            return labels
