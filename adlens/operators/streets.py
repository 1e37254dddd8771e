"""Street names across spellings (X5, F5): names a few typing errors apart.

Comparing all names with all is quadratic. Two names within k edits share all
but k·q of their q-grams, so, with each name's grams in one global order
(rarest first), they share a gram among the first k·q + 1 of each. Only names
that share such a gram and differ by at most k in length are compared, by the
exact edit distance. Names too short to have that many grams are found by what
is left after deleting up to k characters: two names within k edits have one
such remainder in common. Both ways are exact; no pair is missed.

The work is on distinct names. Hot grams are common grams, and these come last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sizing import bounded_broadcast, pin

Q = 2
# stands before and after a name; no name holds it
_PAD = "\u0001"


def _grams(name: Column) -> Column:
    """The name's q-grams, the second and later ones of a kind numbered, so
    that sets of these behave like bags of grams."""
    padded = F.concat(F.lit(_PAD * (Q - 1)), name, F.lit(_PAD * (Q - 1)))
    grams = F.transform(F.sequence(F.lit(1), F.length(padded) - (Q - 1)), lambda i: F.substring(padded, i, Q))
    return F.transform(grams, lambda g, i: F.concat(g, (F.size(F.filter(F.slice(grams, 1, i), lambda x: x == g))).cast("string")))


def _remainders(name: Column, edits: int) -> Column:
    """What is left of a name after deleting up to ``edits`` characters."""
    found = F.array(name)
    for _ in range(edits):
        shorter = F.flatten(F.transform(found, lambda x: F.when(F.length(x) > 0, F.transform(
            F.sequence(F.lit(1), F.length(x)), lambda i: F.concat(F.substring(x, F.lit(1), i - 1), F.substring(x, i + 1, F.length(x)))))
            .otherwise(F.array().cast("array<string>"))))
        found = F.array_distinct(F.concat(found, shorter))
    return found


def similar_pairs(names: DataFrame, name: str = "name", edits: int = 1) -> DataFrame:
    """All pairs (a, b), a < b, of different names at most ``edits`` apart
    (insertions, deletions and replacements of characters)."""
    if edits < 1:
        raise ValueError("at least one edit")
    prefix = edits * Q + 1
    shortest = prefix - Q + 1                     # names from this length on have prefix grams or more
    words = pin(names.select(F.col(name).alias("name")).where("name is not null").distinct().withColumn("len", F.length("name")))
    grams = pin(words.where(F.col("len") >= shortest).select("name", "len", F.explode(_grams(F.col("name"))).alias("key")))
    often = bounded_broadcast(pin(grams.groupBy("key").agg(F.count(F.lit(1)).alias("often"))))
    first = Window.partitionBy("name").orderBy("often", "key")     # a window holds the grams of one name
    heads = grams.join(often, "key").withColumn("place", F.row_number().over(first)).where(F.col("place") <= prefix).select("name", "len", "key")
    rests = words.where(F.col("len") < shortest + edits).select("name", "len", F.explode(_remainders(F.col("name"), edits)).alias("key"))
    keys = pin(heads.withColumn("kind", F.lit(0)).unionByName(rests.withColumn("kind", F.lit(1))))
    a, b = keys.alias("a"), keys.alias("b")
    met = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.kind") == F.col("b.kind")) & (F.col("a.name") < F.col("b.name"))
                 & (F.abs(F.col("a.len") - F.col("b.len")) <= edits)).select(F.col("a.name").alias("a"), F.col("b.name").alias("b")).distinct()
    return met.where(F.levenshtein("a", "b", edits) >= 0)


def groups(pairs: DataFrame) -> DataFrame:
    """Connected names: (name, first), ``first`` the least name of the group.
    Each round every name takes the least label around it and then its
    label's label; rounds go on until nothing changes."""
    edges = pin(pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    now = pin(edges.groupBy(F.col("a").alias("name")).agg(F.least(F.min("b"), F.first("a")).alias("first")))
    while True:
        around = edges.join(now.select(F.col("name").alias("b"), "first"), "b").groupBy(F.col("a").alias("name")).agg(F.min("first").alias("near"))
        lower = now.join(around, "name").select("name", F.least("first", "near").alias("first"), F.col("first").alias("_old"))
        jump = now.select(F.col("name").alias("first"), F.col("first").alias("_far"))
        new = pin(lower.join(jump, "first", "left").select("name", F.least("first", F.coalesce("_far", "first")).alias("first"), "_old"))
        if new.where("first <> _old").isEmpty():
            return new.select("name", "first")
        now = new.select("name", "first")


def canonical_names(ads: DataFrame, column: str, edits: int = 1) -> DataFrame:
    """(name, canonical, n): every spelling with the one its group goes by,
    the most frequent (of equally frequent ones the least), and its rows."""
    counts = pin(ads.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("name")).agg(F.count(F.lit(1)).alias("n")))
    joined = counts.join(groups(similar_pairs(counts, "name", edits)), "name", "left").withColumn("first", F.coalesce("first", "name"))
    best = joined.groupBy("first").agg(F.min_by("name", F.struct((-F.col("n")).alias("n"), "name")).alias("canonical"))
    return joined.join(best, "first").select("name", "canonical", "n")
