"""Connected components of a graph given as a table of links, by repeated contraction in random order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Joins that are composed before their result is stored.
JOINS = 4


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of ``links``; the component is its smallest node.

    Each round deals all nodes a new random order (a hash of round and node) and merges every node into the first of
    its neighbours and itself. On a chain half of the nodes are nobody's first, whatever their numbers are, so rounds
    grow with the logarithm of the longest chain; a star is gone after a few. Only links between nodes that are still
    apart go on. A link with a null end, or from a node to itself, is no link; repeated links count once. Without links
    the result is empty.
    """
    ends = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    apart = stored(ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    rounds: list[DataFrame] = []
    while not apart.isEmpty():

        def dealt(node: str, at: int = len(rounds)) -> Column:
            return F.struct(F.xxhash64(F.lit(at), node).alias("order"), F.col(node).alias("node"))

        both = apart.select("a", dealt("b").alias("_to")).union(apart.select(F.col("b").alias("a"), dealt("a").alias("_to")))
        first = both.groupBy("a").agg(F.min("_to").alias("_to"))
        step = stored(first.select("a", F.least("_to", dealt("a"))["node"].alias("to")), "contraction")
        rounds.append(step)
        left = apart.join(step.select("a", F.col("to").alias("_a")), "a")
        moved = left.join(step.select(F.col("a").alias("b"), F.col("to").alias("_b")), "b")
        apart = stored(
            moved.filter("_a <> _b").select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct(),
            "links",
        )
    if not rounds:
        return ends.select(F.col("a").alias("node"), F.col("a").alias("component")).limit(0)
    # From the last round, the smallest, to the first: each is looked up in the ones after it.
    roots = rounds[-1]
    for at, step in enumerate(reversed(rounds[:-1]), 1):
        jump = roots.select(F.col("a").alias("to"), F.col("to").alias("_to"))
        roots = step.join(jump, "to", "left").select("a", F.coalesce("_to", "to").alias("to"))
        if at % JOINS == 0:
            roots = stored(roots, "roots")
    roots = stored(roots, "roots")
    smallest = roots.groupBy("to").agg(F.min("a").alias("component"))
    return stored(roots.join(smallest, "to").select(F.col("a").alias("node"), "component"), "components")
