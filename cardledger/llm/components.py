"""Connected components by the smallest label, as joins of slim rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cardledger.sources.scratch import saved


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for edges (a, b): the smallest node id of the connected component.

    Each round a node takes the smallest label of its neighbours, then the label that this label's
    own node has, so that long chains shrink by half and not by one. Every round is a table in the
    shared folder. It ends when no label changes; nothing but that one number reaches the driver.
    """
    both = saved(
        edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges"
    )
    labels = saved(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        jump = labels.select(F.col("node").alias("_of"), F.col("label").alias("jump"))
        new = (
            labels.join(near, "node")
            .join(jump, F.col("label") == F.col("_of"), "left")
            .select(
                "node",
                F.least("label", "near", F.coalesce("jump", "label")).alias("label"),
                (F.least("label", "near", F.coalesce("jump", "label")) < F.col("label")).alias("moved"),
            )
        )
        new = saved(new, "labels")
        moved = new.where("moved").limit(1).count()
        labels = new.select("node", "label")
        if not moved:
            return labels
