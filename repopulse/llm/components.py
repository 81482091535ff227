"""Connected components of an edge table by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repopulse.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for the nodes of edges ``a``, ``b``.

    Each round a node takes the smallest label around it, then the label of that label,
    so chains shorten by half or more a round. Rounds are written to the shared scratch
    folder; neighbours are reduced by an aggregate, never gathered.
    """
    both = stored(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))),
        "edges",
    )
    labels = stored(
        both.groupBy(F.col("a").alias("node")).agg(
            F.least("node", F.min("b")).alias("component")
        ),
        "labels",
    )
    while True:
        around = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        lowered = labels.join(around, "node").select(
            "node", "component", F.least("component", "near").alias("lower")
        )
        jump = labels.select(F.col("node").alias("lower"), F.col("component").alias("jumped"))
        moved = stored(
            lowered.join(jump, "lower").select(
                "node", "component", F.least("lower", "jumped").alias("new")
            ),
            "labels",
        )
        labels = moved.select("node", F.col("new").alias("component"))
        if moved.where("component <> new").isEmpty():
            return labels
