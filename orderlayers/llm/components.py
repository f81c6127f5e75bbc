"""Connected components by hooking to smaller neighbours, root finding and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlayers.llm.common import stored


def _rooted(parents: DataFrame) -> DataFrame:
    """Follow ``parents`` (node, parent; parents are smaller or equal) up to the roots.

    Distances to the root halve in each round.
    """
    while True:
        above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        step = stored(
            parents.join(above, "parent", "left").select(
                "node",
                F.coalesce("grand", "parent").alias("parent"),
                (F.coalesce("grand", "parent") != F.col("parent")).alias("moved"),
            ),
            "component-roots",
        )
        parents = step.select("node", "parent")
        if step.filter("moved").isEmpty():
            return parents


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges``, root the smallest node it reaches.

    Edges with a NULL end or two equal ends link nothing; edges may repeat and come in either
    direction. Every round at least halves the groups that still have an edge, and only sums
    and joins on single nodes move data: a node with very many edges sends one row per task
    to the aggregation, and the joins read stored tables, so that Spark can split its rows.
    """
    links = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = stored(both, "component-edges")
    labels = None
    while True:
        parents = stored(
            both.groupBy("a")
            .agg(F.min("b").alias("least"))
            .select(F.col("a").alias("node"), F.least("a", "least").alias("parent")),
            "component-parents",
        )
        parents = _rooted(parents)
        if labels is None:
            labels = parents
        else:
            above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("upper"))
            labels = stored(
                labels.join(above, "parent", "left").select(
                    "node", F.coalesce("upper", "parent").alias("parent")
                ),
                "component-labels",
            )
        ends_a = parents.select(F.col("node").alias("a"), F.col("parent").alias("root_a"))
        ends_b = parents.select(F.col("node").alias("b"), F.col("parent").alias("root_b"))
        half = stored(
            both.join(ends_a, "a").filter(F.col("root_a") != F.col("b")).select("root_a", "b"),
            "component-half",
        )
        both = stored(
            half.join(ends_b, "b")
            .filter("root_a <> root_b")
            .select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
            .distinct(),
            "component-edges",
        )
        if both.isEmpty():
            return labels.select("node", F.col("parent").alias("root"))
