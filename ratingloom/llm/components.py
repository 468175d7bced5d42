"""Connected components of a table of links, by hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ratingloom.session import durable


def _jumped(parents: DataFrame) -> DataFrame:
    """Every node with the root of its tree; ``parents`` (node, parent) always points to smaller ids."""
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("next"))
        farther = durable(parents.join(up, "parent", "left").select("node", F.coalesce("next", "parent").alias("parent"), (F.col("next") < F.col("parent")).alias("moved")))
        parents = farther.select("node", "parent")
        if farther.filter("moved").isEmpty():
            return parents


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b), root being the smallest id it can reach.

    Each round hooks every tree to the smallest tree it has a link to, flattens the trees by
    pointer jumping, and keeps only the links between different trees; the number of trees at
    least halves. Rounds and jumps hand their small tables over in the shared folder. Rows with
    a null or with equal ends are ignored.
    """
    links = durable(links.select("a", "b").filter("a <> b").distinct())
    roots = None
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        hooked = durable(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("parent")))
        trees = _jumped(hooked)
        if roots is None:
            roots = trees.select("node", F.col("parent").alias("root"))
        else:
            step = trees.select(F.col("node").alias("root"), "parent")
            roots = durable(roots.join(step, "root", "left").select("node", F.coalesce("parent", "root").alias("root")))
        for end in ("a", "b"):
            new = trees.select(F.col("node").alias(end), "parent")
            links = links.join(new, end).drop(end).withColumnRenamed("parent", end)
        links = durable(links.select("a", "b").filter("a <> b").distinct())
    if roots is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots
