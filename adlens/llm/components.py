"""Connected components of an edge table by alternating large and small stars
(Kiveris et al., "Connected Components in MapReduce and Beyond").

Each step is an aggregation (the smallest neighbour, combined before the
shuffle) and a join back, so a node with very many edges is never gathered in
one task: the joins are splittable by adaptive execution. Every step is
written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sizing import pin


# Edges up to which the smallest neighbours are broadcast (two bigints a node)
# instead of shuffling the edges to them as well.
BROADCAST_EDGES = 100_000


def _with_least(pairs: DataFrame, few: bool) -> DataFrame:
    """Add ``m``, the least of u and its neighbours, to rows of u and v."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(F.broadcast(least) if few else least, "u")


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) for every node
    of the edges ``a``, ``b``; nodes without an edge do not appear. Steps go on
    until nothing changes; each lowers labels, so they come to an end."""
    both = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now, mark = pin(both), None
    few = now.count() <= BROADCAST_EDGES
    while True:
        around = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # as many rows as edges; those that fell together are dropped below
        large = pin(_with_least(around, few).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        small = _with_least(large, few)
        now = pin(small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                  .unionByName(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        row = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if (row["n"], row["h"]) == mark:
            break
        mark, few = (row["n"], row["h"]), row["n"] <= BROADCAST_EDGES
    flat = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return flat.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
