"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelvane.llm.common import saved


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of every node on an edge (columns ``a, b``, long).

    Each round gives a node the smallest label among its neighbours and then the
    label of that label, so paths shorten by more than half; labels are
    combined before the shuffle. Stops when a round changes nothing.
    """
    both = saved(edges.select("a", "b").union(edges.select("b", "a")).filter(F.col("a") != F.col("b")).distinct())
    labels = saved(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.first("a"), F.min("b")).alias("component")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "a"), "a").groupBy(
            F.col("b").alias("node")).agg(F.min("component").alias("near"))
        stepped = labels.join(near, "node").select(
            "node", F.col("component").alias("before"), F.least("component", "near").alias("component"))
        roots = labels.select(F.col("node").alias("component"), F.col("component").alias("root"))
        after = saved(stepped.join(roots, "component", "left").select(
            "node", "before", F.least("component", "root").alias("component")))
        labels = after.select("node", "component")
        if after.filter(F.col("before") != F.col("component")).isEmpty():
            return labels
