"""Connected components of a table of links, worked out by joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogflow.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that a link (a, b) names; the component is its smallest node.

    In a round every node points to its smallest neighbour or itself, pointers are followed
    twice, and links are taken between the nodes pointed to. A component shrinks to less than half
    in a round. A node with many links is only met in minima, which are taken in part before the shuffle,
    and in joins that Spark can split.
    """
    left = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    labels = None
    while not left.isEmpty():
        ends = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = stored(ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("to")), "pointers")
        for _ in range(2):
            smallest = _follow(smallest, smallest)
        smallest = stored(smallest, "pointers")
        labels = smallest if labels is None else stored(_follow(labels, smallest), "labels")
        for end in ("a", "b"):
            left = left.join(smallest.select(F.col("node").alias(end), F.col("to").alias("_to")), end).drop(end).withColumnRenamed("_to", end)
        left = stored(left.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    if labels is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels.withColumnRenamed("to", "component")


def _follow(pointers: DataFrame, onward: DataFrame) -> DataFrame:
    further = onward.select(F.col("node").alias("_n"), F.col("to").alias("_t"))
    return pointers.join(further, F.col("to") == F.col("_n"), "left").select("node", F.coalesce("_t", "to").alias("to"))
