"""Connected components of a list of edges, in Spark.

Every round points each node at its smallest neighbour, follows the pointers twice, and replaces
the nodes of each edge by what they point at. Edges within a component vanish, so the graph shrinks
until none is left. Nothing is collected; each round's tables are staged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake import staging


def _renamed(edges: DataFrame, parents: DataFrame) -> DataFrame:
    """Edges between the parents of their ends; those within one parent are dropped."""
    first = parents.toDF("a", "parent_a")
    second = parents.toDF("b", "parent_b")
    ends = edges.join(first, "a", "left").join(second, "b", "left")
    ends = ends.select(F.coalesce("parent_a", "a").alias("x"), F.coalesce("parent_b", "b").alias("y"))
    return ends.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _jumped(parents: DataFrame) -> DataFrame:
    next_ = parents.toDF("parent", "grand")
    return parents.join(next_, "parent", "left").select("node", F.coalesce("grand", "parent").alias("parent"))


def components(edges: DataFrame) -> DataFrame:
    """Columns node, label: the smallest node that each node of `edges` (a, b) reaches."""
    edges = staging.stage(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )
    labels = None
    while not edges.isEmpty():
        ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = ends.groupBy(F.col("a").alias("node")).agg(
            F.least(F.min("a"), F.min("b")).alias("parent")
        )
        parents = staging.stage(_jumped(_jumped(staging.stage(parents))))
        if labels is None:
            labels = parents.select("node", F.col("parent").alias("label"))
        else:
            moved = labels.join(parents.toDF("label", "parent"), "label", "left")
            labels = staging.stage(moved.select("node", F.coalesce("parent", "label").alias("label")))
        edges = staging.stage(_renamed(edges, parents))
    if labels is None:
        node = edges.schema["a"].dataType
        labels = edges.select(F.col("a").alias("node"), F.col("b").cast(node).alias("label"))
    return labels
