"""Connected components of an edge table by distributed label propagation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallykeep.llm.common import durable


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every end of an edge (a, b): the smallest node it reaches.

    Every round a node takes the smallest label among its neighbours' and its own, and
    then the label of that label, so chains shorten by half or more. Labels are
    materialised each round, in one job. A node with very many edges is a hot key of a plain join of
    two materialised tables, which AQE splits, and the smallest label is summed up in
    every task before it is shuffled.
    """
    distinct = edges.filter(F.col("a") != F.col("b")).distinct()
    both = durable(distinct.unionByName(distinct.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("component"))
    labels, before = _observed(labels)
    while True:
        heard = both.join(labels, both["a"] == labels["node"]).select(F.col("b").alias("node"), "component")
        nearest = heard.unionByName(labels).groupBy("node").agg(F.min("component").alias("component"))
        above = nearest.select(F.col("node").alias("component"), F.col("component").alias("top"))
        labels, after = _observed(nearest.join(above, "component").select("node", F.col("top").alias("component")))
        if before == after:
            return labels
        before = after


def _observed(labels: DataFrame) -> tuple[DataFrame, object]:
    """Materialised labels, and a number that falls whenever a label does, from the same job."""
    seen = Observation()
    total = F.sum(F.col("component").cast("decimal(38,0)")).alias("total")
    return durable(labels.observe(seen, total)), seen.get["total"]
