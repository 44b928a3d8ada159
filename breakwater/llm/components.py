"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from breakwater.llm.tables import discard, keep


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that links lead to, for each node in ``links`` (a, b).

    Each round every node takes the smallest of itself and its neighbours, follows these steps
    on, and links are contracted to where their ends have come; the rounds end when no link is
    left, after a number that grows with the logarithm of a component's size. Each round starts
    from written tables, so that joins on a node with many links can be split.
    """
    links = keep(links.where("a <> b").select("a", "b"), "links")
    labels = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = keep(both.groupBy("a").agg(F.least("a", F.min("b")).alias("to")), "step")
        for _ in range(2):
            before, further = step, step.select(F.col("a").alias("_at"), F.col("to").alias("_on"))
            step = keep(
                step.join(further, F.col("to") == F.col("_at")).select("a", F.col("_on").alias("to")), "step"
            )
            discard(before)
        if labels is None:
            labels = keep(step.select(F.col("a").alias("node"), F.col("to").alias("component")), "labels")
        else:
            before, moved = labels, labels.join(step, F.col("component") == F.col("a"), "left")
            labels = keep(moved.select("node", F.coalesce("to", "component").alias("component")), "labels")
            discard(before)
        one = step.select("a", F.col("to").alias("_a"))
        two = step.select(F.col("a").alias("b"), F.col("to").alias("_b"))
        before = links
        links = keep(links.join(one, "a").join(two, "b").where("_a <> _b").select(
            F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")
        ).distinct(), "links")
        discard(before, step)
        if links.isEmpty():
            discard(links)
            return labels


def smallest_ids(rows: DataFrame, labels: DataFrame, node: str, row_id: str) -> DataFrame:
    """``rows`` with ``component_id``: the smallest id of a row of the same component. A node
    without links is a component of its own; a row whose node is null is alone."""
    nodes = keep(rows.where(F.col(node).isNotNull()).groupBy(node).agg(F.min(row_id).alias("_least")), "nodes")
    labels = labels.select(F.col("node").alias("_node"), "component")
    placed = keep(
        nodes.join(labels, F.col(node) == F.col("_node"), "left").select(
            node, "_least", F.coalesce("component", node).alias("component")
        ),
        "placed",
    )
    least = keep(placed.groupBy("component").agg(F.min("_least").alias("component_id")), "least")
    found = keep(placed.join(least, "component").select(F.col(node).alias("_node"), "component_id"), "found")
    discard(nodes, placed, least)
    joined = rows.join(found, F.col(node) == F.col("_node"), "left").drop("_node")
    return joined.withColumn("component_id", F.when(F.col(node).isNull(), F.col(row_id)).otherwise(F.col("component_id")))
