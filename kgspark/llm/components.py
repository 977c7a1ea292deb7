"""Connected components by alternating large-star and small-star (Kiveris et al., 2014).

Each round is two joins on the edge list, written to the shared folder; no
neighbour list is ever collected, so a node may have any number of edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kgspark.llm.shared import drop_table, materialize


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first())


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """(node, label) of every node with an edge, as a shared table; label: the component's smallest node.

    edges: two bigint columns a and b; repeated rows, loops and both directions are
    allowed.  A component of any shape of 2**most nodes ends within `most` rounds; more are an error.
    """
    now = materialize(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(now)
    for _ in range(most):
        if not state[0]:
            break
        after = materialize(_small(_large(now)), now)
        fresh, now = _state(after), after
        if fresh == state:
            break
        state = fresh
    else:
        raise RuntimeError(f"components: no end after {most} rounds")
    return materialize(now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()), now)
