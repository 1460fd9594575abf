"""Connected components of an edge table, by contracting it until no edge is left.

In each round every node takes the smallest node next to it as its parent, edges move to the
parents, and loops and repeats go.  Each round is written to the shared folder, so a lost executor
costs that round at most.  Nothing is collected; a node with very many edges is pre-aggregated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meanline.sources.storage import shared_table


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component is its smallest node.

    Loops and repeated edges change nothing; an edge with a null end is left out.
    """
    left = shared_table(
        edges.where("a is not null and b is not null and a != b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "edges",
    )
    member = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = shared_table(
            both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("p"))
            .select("node", F.least("node", "p").alias("parent")),
            "parents",
        )
        above = parent.select(F.col("node").alias("parent"), F.col("parent").alias("top"))
        parent = shared_table(parent.join(above, "parent").select("node", F.col("top").alias("parent")), "parents")
        if member is None:
            member = parent.withColumnRenamed("parent", "component")
        else:
            step = parent.withColumnRenamed("node", "component")
            member = shared_table(
                member.join(step, "component", "left").select("node", F.coalesce("parent", "component").alias("component")),
                "members",
            )
        at = lambda end, to: parent.select(F.col("node").alias(end), F.col("parent").alias(to))
        moved = left.join(at("a", "pa"), "a").join(at("b", "pb"), "b")
        left = shared_table(
            moved.where("pa != pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(),
            "edges",
        )
    if member is None:
        return left.select(F.col("a").alias("node"), F.col("a").alias("component"))
    return member
