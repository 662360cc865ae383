"""Connected components of an edge table, by hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxlake.sources.scratch import stored


def _roots(parent: DataFrame) -> DataFrame:
    """Follow (node, parent) to the end; each pass halves the way."""
    while True:
        up = parent.select(F.col("node").alias("_n"), F.col("parent").alias("_p"))
        joined = parent.join(up, F.col("parent") == F.col("_n"), "left")
        parent = stored(
            joined.select(
                "node", F.coalesce("_p", "parent").alias("parent"), F.col("_p").isNotNull().alias("moved")
            ),
            "parents",
        )
        if parent.filter("moved").isEmpty():
            return parent.drop("moved")
        parent = parent.drop("moved")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that an edge (a, b) touches; the component is its least node.

    In a round every component hooks onto its smallest neighbour below it, chains are followed to
    their ends, and edges inside one component go. Nothing but emptiness tests reaches the driver.
    """
    open_edges = stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a <> b")
        .distinct(),
        "edges",
    )
    nodes = open_edges.select(F.col("a").alias("node")).union(open_edges.select("b")).distinct()
    label = stored(nodes.withColumn("component", F.col("node")), "labels")
    while not open_edges.isEmpty():
        hooks = open_edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("parent"))
        roots = _roots(hooks).select(F.col("node").alias("_n"), F.col("parent").alias("_root"))

        def relabelled(df: DataFrame, column: str, roots: DataFrame = roots) -> DataFrame:
            moved = df.join(roots, F.col(column) == F.col("_n"), "left")
            return moved.withColumn(column, F.coalesce("_root", column)).drop("_n", "_root")

        label = stored(relabelled(label, "component"), "labels")
        both = relabelled(relabelled(open_edges, "a"), "b")
        open_edges = stored(
            both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .filter("a <> b")
            .distinct(),
            "edges",
        )
    return label
