"""Sharding by proportional stratified interleaving.

Rows are put in a seeded random order within their source, and row r of a
source of n rows (r from 0) gets the share (r + u) / n of the way through it,
where u in (0, 1) is drawn for the source. Sorted by share, every stretch of
the order holds each source in proportion, one row more or less; cut into
stretches of equal length, every shard therefore has the mixture of the whole,
and the rows of a shard are mixed in the same way. The draw u spreads the rows
of small sources, which would otherwise all come at the same places.

Nothing is gathered per source or per shard: a rank is the row's place in a
range-sorted written table (``rank_within``), so a source that holds a third of
all rows spreads over many tasks. Only the columns asked for are moved.

Odd input: a null source is a source of its own; null ids and texts are
allowed; rows that repeat (id and text) keep every copy and differ only by
which copy comes first; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import rank_within
from ..operators.sizing import bounded_broadcast, pin

#: Seed of the order within a source and of the sources' draws.
SEED = 0


def _first_word(digest: Column) -> Column:
    """The first 32 bits of an md5 digest as a fraction inside (0, 1)."""
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / float(1 << 32)


def interleave(docs: DataFrame, shards: int, seed: int = SEED, keep: list[Column] | None = None) -> DataFrame:
    """Every row's place: (row, source, share, shard, slot). ``row`` is a
    struct of the columns ``keep`` (all by default), so no name clashes.
    Shards count from 0, and their row counts differ by one at most; slots
    count from 0 within a shard, in the order of the shares."""
    if shards < 1:
        raise ValueError("at least one shard")
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit("")))
    name = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), "source"))
    rows = docs.select(F.struct(*(keep or [F.col("*")])).alias("row"), "source", F.md5(text).alias("key"),
                       _first_word(F.md5(F.concat(F.lit(f"{seed}:"), name))).alias("draw"),
                       F.monotonically_increasing_id().alias("tie"))
    rows = pin(rows)   # the texts are read once, and the tie-break is fixed
    total = rows.count()
    if total == 0:
        return rows.select("row", "source", F.col("draw").alias("share"), F.lit(0).alias("shard"), F.col("tie").alias("slot"))
    sizes = bounded_broadcast(pin(rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"))))
    ranked = rank_within(rows, ["source"], ["key", "tie"], "place").alias("r").join(
        sizes.alias("s"), F.col("r.source").eqNullSafe(F.col("s.source")))
    shares = ranked.select("row", "r.source", "key", "tie", ((F.col("place") - 1 + F.col("draw")) / F.col("n")).alias("share"))
    order = rank_within(shares, [], ["share", "source", "key", "tie"], "place").withColumn("place", F.col("place") - 1)
    placed = order.withColumn("shard", F.expr(f"place * {shards} div {total}"))
    return placed.select("row", "source", "share", F.col("shard").cast("int").alias("shard"),
                         F.expr(f"place - (shard * {total} + {shards - 1}) div {shards}").alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int, seed: int = SEED) -> None:
    """Write the rows as Parquet folders ``shard=K``, each in the order of its
    slots; a column of ``docs`` called shard or slot gives way to the new one.
    A shard is one file or, when it is large, several that follow each other."""
    placed = interleave(docs, shards, seed)
    own = [F.col("row")[c].alias(c) for c in docs.columns if c not in ("shard", "slot")]
    (placed.select("shard", "slot", *own).repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.mode("overwrite").partitionBy("shard").parquet(path))


def mixture(placed: DataFrame) -> DataFrame:
    """Rows of every source in every shard: (shard, source, n)."""
    return placed.groupBy("shard", "source").agg(F.count(F.lit(1)).alias("n"))
