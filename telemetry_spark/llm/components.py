"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_spark.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for the nodes of links (a, b); a component is named by its smallest node.

    Every round points each node at its smallest neighbour, follows pointers twice and contracts the graph to where they lead, until no
    link is left: a round at least halves the nodes that still have one. The neighbours' minimum combines before the shuffle, so
    a node with very many links is no hot spot; all that is kept between rounds are written tables of pairs.
    """
    edges = written(links.select("a", "b").where("a <> b").distinct(), "component-links")
    found = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("parent"))
        for _ in range(2):
            parents = written(parents, "component-parents")
            above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
            parents = parents.join(above, "parent").select("node", F.col("above").alias("parent"))
        parents = written(parents, "component-parents")
        to = lambda end: parents.select(F.col("node").alias(end), F.col("parent").alias(f"to_{end}"))  # noqa: B023, E731
        edges = edges.join(to("a"), "a").join(to("b"), "b").select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))
        edges = written(edges.where("a <> b").distinct(), "component-links")
        if found is None:
            found = parents.withColumnRenamed("parent", "component")
        else:
            moved = parents.select(F.col("node").alias("component"), "parent")
            found = found.join(moved, "component", "left").select("node", F.coalesce("parent", "component").alias("component"))
        found = written(found, "component-nodes")
    if found is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component")).limit(0)
    return found
