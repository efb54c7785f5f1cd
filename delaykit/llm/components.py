"""Connected components of a graph kept in tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.llm.common import stored


def _roots(up: DataFrame) -> DataFrame:
    """(node, up) with each node's last ancestor; steps double, so rounds are the logarithm of the depth."""
    while True:
        above = up.select(F.col("node").alias("above"), F.col("up").alias("further"))
        new = stored(up.join(above, F.col("up") == F.col("above")).select("node", "further", "up"), "roots")
        if new.filter("further <> up").isEmpty():
            return new.select("node", "up")
        up = new.select("node", F.col("further").alias("up"))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` (a, b) reaches.

    Each node points to its smallest neighbour, if that is smaller, which makes a forest; its trees become
    the nodes of the next, much smaller graph, until no edge is left between trees. Tables are stored on the
    way. Only emptiness is asked for by the driver, and no step brings a node's neighbours together in a row.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.filter("a <> b").distinct(), "edges")
    levels = []
    while True:
        up = both.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("up"))
        roots = _roots(stored(up, "up"))
        levels.append(roots)
        left = roots.select(F.col("node").alias("a"), F.col("up").alias("root_a"))
        right = roots.select(F.col("node").alias("b"), F.col("up").alias("root_b"))
        trees = both.join(left, "a").join(right, "b").filter("root_a <> root_b")
        both = stored(trees.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).distinct(), "edges")
        if both.isEmpty():
            break
    found = levels.pop().select("node", F.col("up").alias("component"))
    while levels:
        end = found.select(F.col("node").alias("end"), F.col("component").alias("beyond"))
        found = levels.pop().join(end, F.col("up") == F.col("end"), "left").select(
            "node", F.coalesce("beyond", "up").alias("component")
        )
    return stored(found, "components")
