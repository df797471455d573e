"""Connected components of a table of links, in Spark throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def _relabel(df: DataFrame, column: str, hooks: DataFrame) -> DataFrame:
    to = hooks.select(F.col("r").alias(column), F.col("m").alias("_m"))
    return df.join(to, column, "left").withColumn(column, F.coalesce("_m", column)).drop("_m")


def components(links: DataFrame) -> DataFrame:
    """(node, component): for each end of the links (columns a, b) the smallest node it is linked with.

    Each round, every node points to its smallest neighbour, chains of pointers are halved until they are flat, and
    the links are redrawn between what is left, so that they shrink at each round. Tables are cut by writing them.
    """
    edges = materialize(links.where("a <> b").select(F.least("a", "b").alias("r"), F.greatest("a", "b").alias("s")).distinct(), "cc-edges")
    labels = edges.select(F.col("r").alias("node")).union(edges.select("s")).distinct().select("node", F.col("node").alias("component"))
    labels = materialize(labels, "cc-labels")
    while not edges.isEmpty():
        both = edges.union(edges.select("s", "r"))
        hooks = materialize(both.groupBy("r").agg(F.min("s").alias("m")).where("m < r"), "cc-hooks")
        while True:
            up = hooks.select(F.col("r").alias("m"), F.col("m").alias("mm"))
            jumped = materialize(hooks.join(up, "m", "left").select("r", F.coalesce("mm", "m").alias("m"), F.col("mm").isNotNull().alias("moved")), "cc-hooks")
            flat = jumped.where("moved").isEmpty()
            discard(hooks)
            hooks = jumped
            if flat:
                break
        new_labels = materialize(_relabel(labels, "component", hooks).select("node", "component"), "cc-labels")
        moved = _relabel(_relabel(edges, "r", hooks), "s", hooks).where("r <> s")
        new_edges = materialize(moved.select(F.least("r", "s").alias("r"), F.greatest("r", "s").alias("s")).distinct(), "cc-edges")
        discard(labels, edges, hooks)
        labels, edges = new_labels, new_edges
    return labels
