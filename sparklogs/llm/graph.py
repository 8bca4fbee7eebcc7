"""Connected components of a graph in tables, by hooking and contraction; nothing is collected."""

from pyspark.sql import DataFrame, functions as F

from .common import bounded, stored


def _flat(parents: DataFrame) -> DataFrame:
    """Follow the parents (node, root) to the end of every chain, twice as far with each step."""
    while True:
        up = parents.select(F.col("node").alias("root"), F.col("root").alias("above"))
        jumped = parents.join(bounded(up), "root").select("node", F.col("above").alias("root"), (F.col("above") < F.col("root")).alias("moved"))
        jumped = stored(jumped, "jumped")
        if jumped.filter("moved").isEmpty():
            return parents
        parents = jumped.select("node", "root")


def rooted(frame: DataFrame, column: str, roots: DataFrame) -> DataFrame:
    """The frame with the nodes of a column replaced by their roots, where they have one."""
    up = roots.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    return frame.join(bounded(up), F.col(column) == F.col("_node"), "left").withColumn(
        column, F.coalesce("_root", column)).drop("_node", "_root")


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) for every node of the edges (a, b).

    In a round every node hooks onto its smallest neighbour if that is smaller, chains are followed to their end, and
    the edges shrink to those between different roots. The smallest neighbour is a minimum, summed up in tasks
    before the shuffle; no list of neighbours is built.
    """
    edges, labels = edges.filter("a <> b").select("a", "b"), None
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        parents = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("v"))
        parents = _flat(stored(parents.select("node", F.least("node", "v").alias("root")), "parents"))
        labels = parents if labels is None else stored(rooted(labels, "root", parents), "labels")
        edges = rooted(rooted(edges, "a", parents), "b", parents).filter("a <> b")
        edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
        if edges.isEmpty():
            return labels
