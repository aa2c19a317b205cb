"""Connected components of an edge DataFrame by alternating star contractions.

The method is that of Kiveris et al., "Connected Components in MapReduce and Beyond"
(2014). No step gathers the neighbours of a node: each takes a minimum per node with partial
aggregation and joins it back to the edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera import scratch
from tessera.operators.keyed import spread_group


def value_links(melted: DataFrame, record_id: str, on: list[str]) -> DataFrame:
    """Edges ``(child, parent)`` from each record to the first record with the same value.

    A value shared by n records gives n - 1 edges, not n²; values of one record give none.
    """
    shared = spread_group(
        melted, on, F.min(record_id).alias("parent"), F.max(record_id).alias("__last")
    ).where(F.col("parent") < F.col("__last"))
    return (
        melted.join(shared, on)
        .where(F.col(record_id) > F.col("parent"))
        .select(F.col(record_id).alias("child"), "parent")
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of each node to the least node near it."""
    both = edges.select(F.col("child").alias("node"), F.col("parent").alias("near")).union(
        edges.select("parent", "child")
    )
    least = spread_group(both, ["node"], F.least("node", F.min("near")).alias("least"))
    return (
        both.join(least, "node")
        .where(F.col("near") > F.col("node"))
        .select(F.col("near").alias("child"), F.col("least").alias("parent"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the least of them."""
    least = spread_group(edges, ["child"], F.min("parent").alias("least"))
    moved = edges.join(least, "child").select(F.col("parent").alias("child"), F.col("least").alias("parent"))
    return (
        moved.union(least.select("child", F.col("least").alias("parent")))
        .where(F.col("child") > F.col("parent"))
        .distinct()
    )


def _is_star_forest(edges: DataFrame) -> bool:
    """Every child has one parent, and no parent is a child."""
    roles = edges.select(F.col("child").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("parent", F.lit(0), F.lit(1))
    )
    crossed = (
        roles.groupBy("node")
        .agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        .where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))
    )
    return crossed.isEmpty()


def stars(edges: DataFrame) -> DataFrame:
    """``(child, parent)`` with the least node of the component as the only parent.

    ``edges`` has ``child > parent``. Each round is written to the shared folder; every round that changes
    something lowers a parent, so the loop ends.
    """
    spark = edges.sparkSession
    current, path = scratch.stored(edges, "edges")
    while not _is_star_forest(current):
        following, next_path = scratch.stored(_small_star(_large_star(current)), "edges")
        scratch.drop(spark, path)
        current, path = following, next_path
    return current


def components(nodes: DataFrame, node: str, edges: DataFrame) -> DataFrame:
    """``(node, component)``: the least node of the component of each node."""
    found = stars(edges).select(F.col("child").alias(node), F.col("parent").alias("component"))
    return nodes.select(node).join(found, node, "left").withColumn(
        "component", F.coalesce("component", node)
    )
