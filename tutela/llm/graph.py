"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tutela.session import keep


def components(edges: DataFrame, name: str = "component") -> DataFrame:
    """(node, root) for every node of the edge table (a, b); root is the smallest node reachable.

    Alternates the large-star and the small-star step: every node hands its larger, then its
    smaller neighbours to the smallest node it sees, until each is linked with its root alone.
    The number of rounds grows with the logarithm of the longest path. Minima are aggregated
    before they move, so a hub costs no more than its edges; each round is a table in the shared
    folder. Loops, repeated edges and edges with a null end carry no information and are ignored.
    """
    pair = edges.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pair, before = keep(pair, name), None
    while True:
        state = pair.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h"),
                         F.sum(F.xxhash64("b", "a") % 1_000_003).alias("s")).first()
        if state == before:
            break
        before = state
        pair = keep(_small_star(_large_star(pair)), name)
    leaves = pair.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return leaves.unionByName(pair.select(F.col("b").alias("node"),
                                          F.col("b").alias("root")).distinct())


def _large_star(pair: DataFrame) -> DataFrame:
    both = pair.unionByName(pair.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(
        "a", F.least("a", "m").alias("m"))
    larger = both.filter(F.col("b") > F.col("a")).join(least, "a")
    return larger.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(pair: DataFrame) -> DataFrame:
    least = pair.groupBy("a").agg(F.min("b").alias("m"))
    moved = pair.join(least, "a")
    out = moved.filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"),
                                                        F.col("m").alias("b"))
    return out.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
