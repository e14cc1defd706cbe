"""Connected components of a link table, by alternating stars.

Each round points every node's larger neighbours at its least neighbour, then
every node and its smaller neighbours at theirs; links only get shorter, and
a component ends as a star around its least node. Rounds are written to the
shared folder, so a lost executor repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first())


def components(links: DataFrame) -> DataFrame:
    """``node, root`` (least node) of every node of ``links`` (``a, b`` longs)."""
    edges = materialize(links.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # a node's own link to its least neighbour is kept by the neighbour's turn or added here
        large = large.unionByName(least.where(F.col("m") < F.col("a")).select("a", F.col("m").alias("b"))).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where(F.col("b") != F.col("m")).select(
            F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
        edges = materialize(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "cc")
        new = _state(edges)
        if new == state:
            break
        state = new
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
