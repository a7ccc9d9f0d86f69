"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import checkpointed, release


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest node among its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours and itself to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, for every node of the undirected long ``edges``.

    Loops, repeated and null edges do not matter. Minima are combined before the shuffle, neighbours are never gathered, and
    rounds grow with the logarithm of the longest path. The driver sees one count and one checksum per round.
    """
    pairs = edges.filter(f"{a} <> {b}").select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    current = checkpointed(pairs)
    state = _state(current)
    while state[0]:
        following = checkpointed(small_star(large_star(current)))
        new_state = _state(following)
        current = following
        release(edges.sparkSession)
        if new_state == state:
            break
        state = new_state
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
