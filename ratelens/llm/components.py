"""Connected components of an edge table by repeated contraction.

Each round every node points to the smallest node among itself and its
neighbours; pointer chains are followed to their ends; edges are rewritten to
those ends and loops dropped.  A round at least halves the nodes that still
have edges.  Aggregates and joins only; every round is written to the shared
folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sized_broadcast, written


def _jump(parents: DataFrame) -> DataFrame:
    """(node, root): follow (node, parent) chains to nodes that have no parent."""
    while True:
        p = parents
        up = p.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        nxt = written(p.join(up, "parent", "left").select(
            "node", F.coalesce("grand", "parent").alias("parent"), F.col("grand").isNotNull().alias("moved")), "cc-jump")
        parents = nxt.select("node", "parent")
        if nxt.where("moved").limit(1).count() == 0:
            return parents.withColumnRenamed("parent", "root")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with an edge to another one; the root is
    some node of the component, the same for all its nodes."""
    spark = edges.sparkSession
    live = written(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct(), "cc-edges")
    kind = live.schema["a"].dataType.simpleString()
    labels = spark.createDataFrame([], f"node {kind}, root {kind}")
    while live.limit(1).count():
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("parent"))
        roots = _jump(written(least.where("parent < node"), "cc-parents"))
        size = roots.count()

        def to_root(df: DataFrame, col: str, roots: DataFrame = roots, size: int = size) -> DataFrame:
            r = sized_broadcast(roots.select(F.col("node").alias(col), F.col("root").alias("_root")), size)
            return df.join(r, col, "left").withColumn(col, F.coalesce("_root", col)).drop("_root")

        moved = to_root(labels, "root") if labels.columns else labels
        labels = written(moved.unionByName(roots.select("node", "root").join(
            moved.select("node"), "node", "left_anti")), "cc-labels")
        live = written(to_root(to_root(live, "a"), "b").where("a <> b").distinct(), "cc-edges")
    # nodes that were roots all along label themselves
    tops = labels.select(F.col("root").alias("node")).distinct().join(labels.select("node"), "node", "left_anti")
    return labels.unionByName(tops.select("node", F.col("node").alias("root")))
