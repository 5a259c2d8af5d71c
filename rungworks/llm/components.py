"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rungworks.session import stage


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of all nodes but the least of each component, which names it.

    ``edges`` has columns ``a`` and ``b``.  Nodes are hung to the least neighbour of theirs, by
    turns seen from above and from below, until every component is a star.  Neighbours
    are never gathered: the least is an aggregate, which rows then look up, so a
    node with any number of edges is an ordinary skewed join.  Rounds are staged and grow
    with the logarithm of the longest path.
    """
    state = stage(_down(edges), "components")
    sign = _sign(state)
    while sign[0]:
        both = state.unionByName(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "components-least")
        hung = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(_down(hung), "components-large")
        least = stage(large.groupBy("a").agg(F.min("b").alias("m")), "components-least")
        met = large.join(least, "a")
        small = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        state = stage(_down(small), "components")
        before, sign = sign, _sign(state)
        if sign == before:
            break
    return state.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _down(edges: DataFrame) -> DataFrame:
    """Each edge once, from the greater node to the less."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _sign(edges: DataFrame) -> tuple[int, int]:
    """Number and check sum of the edges."""
    got = edges.agg(F.count("*").alias("n"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)).alias("x")).first()
    return got["n"], got["x"]
