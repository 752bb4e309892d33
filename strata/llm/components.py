"""Connected components of an edge list, as alternating star contractions.

Every round is two joins and aggregates on the remaining edges; what a round
leaves is written to the shared folder, so lineage stays one round long.  The
number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.where("v > u").join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                           F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 31)))).first())


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges(u, v)`` of integer nodes, in any direction, repeats allowed ->
    ``(node, component)`` for every node on an edge between two different nodes;
    the component is its smallest node.  No edges: an empty result."""
    cur = stored(edges.where("u is not null and v is not null and u != v")
                 .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = _state(cur)
    for _ in range(max_rounds):
        if not state[0]:
            break
        cur = stored(_small_star(_large_star(cur)), "edges")
        before, state = state, _state(cur)
        if before == state:
            break
    else:
        raise RuntimeError("components did not settle")
    return (cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(cur.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())
