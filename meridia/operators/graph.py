"""Networks: connected components, clusters of occupied cells, edges of ordered lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridia.operators.storage import materialise


def connected_components(nodes: DataFrame, edges: DataFrame, node: str = "node", left: str = "a", right: str = "b") -> DataFrame:
    """``node`` and ``component``, the smallest node that it can reach.

    Labels take the minimum over neighbours and then jump to their label's own
    label, so a chain of n nodes takes about log n rounds. Each round is an
    equi-join and a grouped minimum, written to the shared folder.
    """
    both = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u <> v")
    both = materialise(both.union(both.select("v", "u")).distinct(), "edges")
    labels = nodes.select(F.col(node).alias("u"), F.col(node).alias("label")).distinct()
    while True:
        least = both.join(labels.withColumnRenamed("u", "v"), "v").groupBy("u").agg(F.min("label").alias("near"))
        moved = labels.join(least, "u", "left").select("u", "label", F.least("label", F.coalesce("near", "label")).alias("to"))
        jump = labels.select(F.col("u").alias("to"), F.col("label").alias("further"))
        step = materialise(moved.join(jump, "to", "left").select("u", "label", F.least("to", F.coalesce("further", "to")).alias("to")), "labels")
        labels = step.select("u", F.col("to").alias("label"))
        if step.where(F.col("label") != F.col("to")).isEmpty():
            return labels.select(F.col("u").alias(node), F.col("label").alias("component"))


def cell_clusters(points: DataFrame, key: str, cell: str, neighbours: Column, least: int = 2) -> tuple[DataFrame, DataFrame]:
    """Cluster points whose occupied cells are neighbours.

    ``neighbours`` gives an array of cells near ``cell``. Returns the clusters
    (component, member_count, members) of at least ``least`` points, and
    (``key``, component) of every point.
    """
    cells = points.select(F.col(cell).alias("node")).distinct()
    reach = points.select(F.col(cell).alias("a"), F.explode(neighbours).alias("b")).distinct()
    edges = reach.join(cells.withColumnRenamed("node", "b"), "b", "left_semi").where("a < b")
    labels = connected_components(cells, edges).withColumnRenamed("node", cell)
    placed = points.select(key, cell).join(labels, cell).select(key, "component")
    clusters = placed.groupBy("component").agg(F.count("*").alias("member_count"), F.array_sort(F.collect_list(key)).alias("members")).where(F.col("member_count") >= least)
    return clusters, placed


def edges_of_sequences(stops: DataFrame, line: str, order: Sequence[str], node: str) -> DataFrame:
    """Each pair of neighbouring stops of a line once: from_key <= to_key, and the lines that share it."""
    nxt = F.lead(node).over(Window.partitionBy(line).orderBy(*order))
    steps = stops.select(line, F.col(node).alias("_a"), nxt.alias("_b")).where("_b IS NOT NULL AND _a <> _b")
    pair = steps.select(line, F.least("_a", "_b").alias("from_key"), F.greatest("_a", "_b").alias("to_key"))
    return pair.groupBy("from_key", "to_key").agg(F.count_distinct(line).alias("n_lines"), F.min(line).alias("first_line"))
