"""Connected components of pairs, by alternating stars: two shuffles a round, few rounds.

A large star links each node's larger neighbours to its smallest one, a small star links the
smaller ones and the node itself to it (Kiveris et al., 2014). Both keep components whole and
shrink each to a star around its smallest node. A node with very many neighbours is one key of a
join, whose exchange AQE splits, and of a minimum, which is added up before the exchange.
Lineage is cut by a table in the shared folder each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from cellwise.session import removed, written


def _star(both: DataFrame) -> DataFrame:
    """Pairs (node, neighbour) with the least of a node and its neighbours as ``least``."""
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select(F.col("a").alias("a2"), F.least("a", "m").alias("least"))
    return both.join(least, F.col("a") == F.col("a2")).drop("a2")


def _mirrored(pairs: DataFrame) -> DataFrame:
    return pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _state(edges: DataFrame) -> Row:
    """Number and fingerprint of the pairs: a round that leaves them as they were was the last."""
    return edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()


def components(pairs: DataFrame, first: str, second: str) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of a pair of unequal nodes.

    Nodes are of any ordered type. Pairs with a null or with equal ends link nothing. A node in
    no pair is not in the result: it is its own component.
    """
    # A comparison with a null is not true, so such pairs go too.
    unequal = pairs.filter(F.col(first) != F.col(second))
    edges = unequal.select(F.greatest(first, second).alias("a"), F.least(first, second).alias("b"))
    edges = written(edges.distinct(), "links")
    before = _state(edges)
    # Without a link there is nothing to do, and links that are stars already take one round.
    while before[0]:
        # Large star: the larger neighbours of every node, linked to its least one.
        large = _star(_mirrored(edges)).filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        # Small star: every node's smaller neighbours and itself, linked to its least one.
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        joined = large.join(least.select(F.col("a").alias("a2"), "least"), F.col("a") == F.col("a2"))
        inner = joined.filter("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        own = least.select("a", F.col("least").alias("b"))
        new = written(inner.union(own).distinct(), "links")
        state = _state(new)
        removed(edges)
        edges = new
        if state == before:
            break
        before = state
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.union(edges.select("b", "b").distinct())
