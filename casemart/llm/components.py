"""Connected components of an edge table, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemart.llm.common import written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): every node of an edge with the smallest node that it can reach.

    Each round every node points to its smallest neighbour or itself, pointers are followed once
    more, and the edges between the nodes pointed to remain; loops go. A round's tables are
    written, so a lost executor repeats one round at most. No node's edges are gathered: minima are
    partial aggregates, and joins on a hub have one row on the other side.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    both = written(both.union(both.select("v", "u")).distinct(), "edges")
    labels = None
    while not both.isEmpty():
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("to"))
        least = written(least, "pointers")
        jump = written(
            least.join(least.select(F.col("u").alias("to"), F.col("to").alias("root")), "to")
            .select("u", "root"),
            "roots",
        )
        if labels is None:
            labels = jump.select(F.col("u").alias("node"), F.col("root").alias("component"))
        else:
            labels = labels.join(
                jump.select(F.col("u").alias("component"), "root"), "component", "left"
            ).select("node", F.coalesce("root", "component").alias("component"))
        labels = written(labels, "labels")
        ends = both.join(jump, "u").select("v", F.col("root").alias("a"))
        ends = ends.join(jump.select(F.col("u").alias("v"), F.col("root").alias("b")), "v")
        both = written(
            ends.filter("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct(),
            "edges",
        )
    if labels is None:
        return both.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return labels
