"""Connected components of a graph given as links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node it is connected with, for all nodes of ``links``.

    ``links`` has the columns ``a`` and ``b`` of one type.  In each round every node hooks to its
    smallest neighbour, the chains so made are flattened by pointer jumping, and the graph shrinks
    to the roots; rounds end when no link is left.  Hubs are only met by aggregates combined
    before their shuffle and by joins, which adaptive execution may split.  No links give no rows.
    """
    edges = stage(
        links.select("a", "b")
        .union(links.select("b", "a"))
        .filter("a <> b")
        .distinct(),
        "edges",
    )
    labels = None
    while not edges.isEmpty():
        parents = stage(
            edges.groupBy("a").agg(F.min("b").alias("b")).select(
                F.col("a").alias("node"), F.least("a", "b").alias("label")
            ),
            "parents",
        )
        while True:
            onward = parents.select(F.col("node").alias("label"), F.col("label").alias("onward"))
            jumped = stage(
                parents.join(onward, "label", "left").select(
                    "node",
                    F.coalesce("onward", "label").alias("label"),
                    (F.coalesce("onward", "label") != F.col("label")).alias("moved"),
                ),
                "jumped",
            )
            parents = jumped.select("node", "label")
            if jumped.filter("moved").isEmpty():
                break
        if labels is None:
            labels = parents
        else:
            onward = parents.select(F.col("node").alias("label"), F.col("label").alias("onward"))
            labels = stage(
                labels.join(onward, "label", "left").select(
                    "node", F.coalesce("onward", "label").alias("label")
                ),
                "labels",
            )
        ends_a = parents.select(F.col("node").alias("a"), F.col("label").alias("root_a"))
        ends_b = parents.select(F.col("node").alias("b"), F.col("label").alias("root_b"))
        edges = stage(
            edges.join(ends_a, "a")
            .join(ends_b, "b")
            .filter("root_a <> root_b")
            .select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
            .distinct(),
            "edges",
        )
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels
