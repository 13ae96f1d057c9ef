"""Connected components of a graph of links, by alternating star contractions.

Each round every vertex hands its larger, then its smaller neighbours to the smallest
vertex it knows; the number of rounds grows with the logarithm of the longest path. All
steps are grouped aggregates and joins; each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.session import stage


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", F.lit(1), "a"))
    )
    return tuple(row.first())


def components(edges: DataFrame) -> DataFrame:
    """``vertex, component`` for every vertex but the smallest of each component.

    ``edges`` has two columns of ids, ``a`` and ``b``, in any order; loops, repeated edges and
    rows with a null are of no effect.
    """
    known = edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = stage(known.distinct(), "links")
    seen = None
    # The contractions end at stars, whatever the graph; a round that changes nothing is the last.
    while True:
        state = _state(edges)
        if state == seen or not state[0]:
            break
        seen = state
        # Larger neighbours go to the smallest vertex in reach.
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("m").alias("a"), "b").distinct()
        # Then the smaller neighbours of each, and itself.
        smallest = large.groupBy("b").agg(F.min("a").alias("m"))
        handed = large.join(smallest, "b")
        small = handed.filter("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
        small = small.union(smallest.select(F.col("m").alias("a"), "b"))
        edges = stage(small.distinct(), "links")
    return edges.select(F.col("b").alias("vertex"), F.col("a").alias("component"))
