"""Connected components by contraction, over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored


def component_roots(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the bigint links (a, b); the root is a node.

    Each round points every node at its smallest neighbour or itself, follows
    that pointer once more, and keeps the links between the nodes pointed at.
    Links and nodes shrink by a constant factor at least, so the rounds grow
    with the logarithm of the nodes. A null or equal pair links nothing.
    """
    edges = stored(links.select("a", "b").filter(F.col("a") != F.col("b")).distinct(), "links")
    steps = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to"))
        nearest = stored(nearest.withColumn("to", F.least("node", "to")), "pointers")
        further = nearest.select(F.col("node").alias("to"), F.col("to").alias("root"))
        step = stored(nearest.join(further, "to").select("node", "root"), "pointers")
        steps.append(step)
        edges = stored(
            _followed(_followed(edges, step, "a"), step, "b")
            .filter(F.col("a") != F.col("b"))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .distinct(),
            "links",
        )
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = steps[0]
    for step in steps[1:]:
        roots = _followed(roots, step, "root")
    return roots


def _followed(df: DataFrame, step: DataFrame, column: str) -> DataFrame:
    """``column`` replaced by its root where the step has one."""
    renamed = step.select(F.col("node").alias("from_node"), F.col("root").alias("to_root"))
    others = [name for name in df.columns if name != column]
    return df.join(renamed, F.col(column) == F.col("from_node"), "left").select(
        *others, F.coalesce("to_root", column).alias(column)
    )
