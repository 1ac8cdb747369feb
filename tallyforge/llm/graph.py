"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.session import stage_table


def components(edges: DataFrame) -> DataFrame:
    """Edges ``a long, b long`` to ``node long, component long``, the smallest node reachable.

    Star contraction: every node points at the smallest of its neighbours, first for the larger
    neighbours and then for the smaller ones, until no edge changes. The number of rounds grows with
    the logarithm of the longest path. Each round is a written table, so nothing hangs on a long
    lineage. Minima are partly aggregated before the shuffle, so a node with very many edges is
    one row of a task in the aggregates.

    Nodes without an edge do not appear; null ends and loops are ignored; no edges give no rows.
    """
    state = stage_table(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while (now := _fingerprint(state)) != seen:
        seen = now
        both = state.select("a", "b").unionByName(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.join(lowest, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.filter("a <> b").distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        joined = large.join(lowest, "a")
        small = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(lowest.select("a", F.col("low").alias("b")))
        state = stage_table(small.filter("a <> b").distinct(), "edges")
    reached = state.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = state.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return reached.unionByName(roots)


def _fingerprint(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges: their number and an order-free sum of hashes."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
