"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): for every node of the edges (a, b), the smallest node it is connected to.

    Rounds of two steps until nothing changes: every node takes the smallest label among its
    neighbours (an aggregation with map-side combining, so hubs are no hot spot), then the label of
    its label. Labels are written each round; only a count passes the driver."""
    both = written(edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
                     .select("node", F.least("node", "near").alias("label")), "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), F.col("label")), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        hooked = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("next"))
        up = labels.select(F.col("node").alias("next"), F.col("label").alias("top"))
        after = written(hooked.join(up, "next", "left").select(
            "node", F.least("next", F.coalesce("top", "next")).alias("label"),
            (F.least("next", F.coalesce("top", "next")) != F.col("label")).alias("moved")), "labels")
        labels = after.select("node", "label")
        if after.filter("moved").isEmpty():
            return labels.select("node", F.col("label").alias("component"))
