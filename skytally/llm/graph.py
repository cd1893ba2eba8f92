"""Connected components of a graph of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.llm.common import stored

MOST_ROUNDS = 60  # the rounds grow with the logarithm of the nodes; this is far above any input


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: long); root is the least node it is linked to.

    Large stars tie the greater neighbours of a node to its least one, small stars the lesser ones.
    Each round is two joins on the node, written to the shared folder; a node with many neighbours
    is folded to its minimum before the shuffle, and its join is one Spark can split.
    Loops and repeated links are ignored; no link gives no row.
    """
    edges = stored(
        links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    seen = None
    for _ in range(MOST_ROUNDS):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        edges = stored(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()
        if state == seen:
            roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return roots.union(roots.select(F.col("root").alias("node"), "root")).distinct()
        seen = state
    raise RuntimeError("the components did not settle")
