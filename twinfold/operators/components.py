"""Connected components by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinfold.sources.scratch import stored


def hop(edges: DataFrame) -> DataFrame:
    """node -> the smallest of itself and its neighbours, for the nodes of edges (src, dst)."""
    both = edges.select(F.col("src").alias("node"), F.col("dst").alias("other")).unionByName(edges.select(F.col("dst").alias("node"), F.col("src").alias("other")))
    return both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("label"))


def relabel(table: DataFrame, column: str, labels: DataFrame) -> DataFrame:
    """table with column replaced by its label, where labels (node, label) has one."""
    mine = labels.select(F.col("node").alias("__node"), F.col("label").alias("__label"))
    found = table.join(mine, table[column] == mine["__node"], "left")
    return found.withColumn(column, F.coalesce("__label", column)).drop("__node", "__label")


def followed(step: DataFrame) -> DataFrame:
    """node -> the end of its way, where step (node, label) leads each node to itself or a smaller one.

    A pass looks two steps ahead, so the way trebles, and short ways, the usual ones, end in the first pass.
    """
    while True:
        one, two = step.toDF("n1", "x1"), step.toDF("n2", "x2")
        ahead = step.join(one, step["label"] == one["n1"], "left").select("node", F.coalesce("x1", "label").alias("far"))
        found = ahead.join(two, ahead["far"] == two["n2"], "left").select("node", "far", F.coalesce("x2", "far").alias("label"))
        jumped = stored(found.select("node", "label", (F.col("far") != F.col("label")).alias("moved")), "jumps")
        step = jumped.select("node", "label")
        if jumped.filter("moved").isEmpty():
            return step


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """node -> label, the smallest node of its component, for every node with an edge.

    Each round points every node to the smallest of its neighbourhood, follows the pointers to their ends,
    which are local minima, and contracts the graph to these. Every node that is left has an edge, and of two
    neighbours one is no local minimum, so at least half of the nodes go in each round, whatever the order of
    ids. Rounds are stored; the loop ends when no edge between different nodes is left. Null ends and loops
    are ignored; no edges give no rows.
    """
    tidy = lambda e: e.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct()
    left = stored(tidy(edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).filter("src is not null and dst is not null and src <> dst")), "edges")
    labels = None
    while not left.isEmpty():
        step = followed(stored(hop(left), "hop"))
        labels = step if labels is None else stored(relabel(labels, "label", step), "labels")
        left = stored(tidy(relabel(relabel(left, "src", step), "dst", step).filter("src <> dst")), "edges")
    if labels is None:
        return left.select(F.col("src").alias("node"), F.col("dst").alias("label"))
    return labels
