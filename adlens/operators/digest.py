"""Snapshot diff by digest trees.

``lifecycle.snapshot_diff`` joins two whole snapshots although most ads are in
both. Here a snapshot is stored by key bucket, and with it a tree of digests:
per leaf bucket the number of keys and two sums of key hashes, per branch (a
group of leaves) the sums over its leaves. Sums do not depend on order or
partitioning and are combined map-side. Two snapshots are compared from the
branches down: only leaves below branches that differ are looked at, and only
rows of leaves that differ are read and joined. Equal digests are taken for
equal key sets (two sums of 64-bit hashes and the counts; 128 bits).

Layout under ``path``: rows/run_date=D/leaf=L, leaves/run_date=D/branch=B,
branches/run_date=D. A date is written by overwriting its folders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sinks.writers import write_dated
from .lifecycle import NEW, REMOVED
from .sizing import bounded_broadcast, pin

#: Leaves of a branch, and the keys of a snapshot that make a leaf (a file of
#: some megabytes; less would be many small files).
FAN, LEAF_KEYS = 16, 100_000
_WIDE = "decimal(38,0)"


def _hashes(key: Column) -> list[Column]:
    """Two independent 64-bit hashes of a key."""
    text = key.cast("string")
    return [F.xxhash64(text), F.conv(F.substring(F.md5(text), 1, 16), 16, 10).cast(_WIDE)]


def _digest(n: Column, rows: Column, h1: Column, h2: Column) -> list[Column]:
    return [F.sum(n).cast("bigint").alias("n_keys"), F.sum(rows).cast("bigint").alias("n_rows"),
            F.sum(h1.cast(_WIDE)).alias("h1"), F.sum(h2.cast(_WIDE)).alias("h2")]


def leaves_for(keys: int, leaf_keys: int = LEAF_KEYS) -> int:
    """The number of leaves for snapshots of so many keys: a power of two from
    4 on. It is fixed for a store; snapshots may grow tenfold behind it."""
    return 1 << max(2, (max(keys, 1) // leaf_keys).bit_length())


def write_snapshots(snapshots: DataFrame, path: str, leaves: int, key: str = "url_hash", day: str = "run_date",
                    fan: int = FAN) -> None:
    """Store the snapshots of the dates in ``snapshots`` (one row per key and
    date is kept, with the number of its rows) and their digest trees.
    ``leaves`` must be the same for all dates of a store (``leaves_for``)."""
    h1, h2 = _hashes(F.col("key"))
    keys = (snapshots.where(F.col(key).isNotNull()).groupBy(F.col(day).alias("run_date"), F.col(key).alias("key"))
            .agg(F.count(F.lit(1)).alias("n_today")).withColumn("leaf", F.pmod(F.xxhash64(F.col("key").cast("string")), F.lit(leaves)).cast("int")))
    write_dated(keys, f"{path}/rows", ["run_date", "leaf"])
    stored = snapshots.sparkSession.read.schema(f"key {snapshots.schema[key].dataType.simpleString()}, n_today bigint, run_date date, leaf int"
                                                ).parquet(f"{path}/rows")
    dates = [r["run_date"] for r in keys.select("run_date").distinct().collect()]      # the dates of one delivery
    own = stored.where(F.col("run_date").isin(dates))
    leaf = own.groupBy("run_date", "leaf").agg(*_digest(F.lit(1), F.col("n_today"), h1, h2))
    leaf = pin(leaf.withColumn("branch", F.floor(F.col("leaf") / fan).cast("int")))
    write_dated(leaf, f"{path}/leaves", ["run_date", "branch"])
    write_dated(leaf.groupBy("run_date", "branch").agg(*_digest(F.col("n_keys"), F.col("n_rows"), F.col("h1"), F.col("h2"))), f"{path}/branches")


_DIGEST = f"n_keys bigint, n_rows bigint, h1 {_WIDE}, h2 {_WIDE}"


def _table(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{path}/{name}")


def _pairs(days: DataFrame) -> DataFrame:
    """Consecutive run dates (run_date, prev_date): a row per date."""
    return days.select("run_date", F.lag("run_date").over(Window.orderBy("run_date")).alias("prev_date"))


def _differing(digests: DataFrame, scope: DataFrame, node: str) -> DataFrame:
    """(run_date, prev_date, node) whose digests differ between the dates of a
    pair; a node that one of them lacks differs. ``scope`` holds the pairs, or
    the pairs' branches whose nodes are looked at."""
    within = [c for c in scope.columns if c == "branch"]
    stored = digests.select(F.col("run_date").alias("_on"), *within, node, F.struct("n_keys", "h1", "h2").alias("digest"))

    def side(day, name):
        return (scope.withColumn("_on", F.col(day)).join(stored, ["_on", *within])
                .select("run_date", "prev_date", node, F.col("digest").alias(name)))

    both = side("prev_date", "p").join(side("run_date", "t"), ["run_date", "prev_date", node], "full_outer")
    return both.where(~F.col("p").eqNullSafe(F.col("t"))).select("run_date", "prev_date", node)


def changed_leaves(spark: SparkSession, path: str, pairs: DataFrame) -> DataFrame:
    """The leaves whose rows must be read, per pair of dates: branches first,
    then the leaves of the branches that differ. A row per changed leaf."""
    branches = _table(spark, path, "branches", f"branch int, {_DIGEST}, run_date date")
    leaves = _table(spark, path, "leaves", f"leaf int, {_DIGEST}, run_date date, branch int")
    scope = pairs.where("prev_date is not null").select("run_date", "prev_date")
    open_ = pin(_differing(branches, bounded_broadcast(pin(scope)), "branch"))
    return pin(_differing(leaves, bounded_broadcast(open_), "leaf"))


def diff(spark: SparkSession, path: str, key_type: str = "string", pairs: DataFrame | None = None) -> DataFrame:
    """J1 without the ads that are still listed: (key, run_date, status) with
    status new or removed, for the pairs (run_date, prev_date), by default all
    consecutive dates stored; every ad of the first date is new then."""
    days = _table(spark, path, "branches", f"branch int, {_DIGEST}, run_date date").select("run_date").distinct()
    every = pairs is None
    pairs = pin(_pairs(days) if every else pairs.select("run_date", "prev_date"))
    # the filter keeps every row; Spark prunes partitions by a join side that has one
    leaves = bounded_broadcast(changed_leaves(spark, path, pairs)).where("leaf >= 0")
    rows = _table(spark, path, "rows", f"key {key_type}, n_today bigint, run_date date, leaf int")
    today = rows.join(leaves, ["run_date", "leaf"]).select("key", "run_date", F.lit(True).alias("_t"))
    before = (rows.withColumnRenamed("run_date", "prev_date").join(leaves, ["prev_date", "leaf"])
              .select("key", "run_date", F.lit(True).alias("_p")))
    both = today.join(before, ["key", "run_date"], "full_outer").where("_t is null or _p is null")
    found = both.select("key", "run_date", F.when(F.col("_t").isNull(), F.lit(REMOVED)).otherwise(F.lit(NEW)).alias("status"))
    if every:
        first = pairs.where("prev_date is null").select("run_date")
        found = found.unionByName(rows.join(F.broadcast(first), "run_date").select("key", "run_date", F.lit(NEW).alias("status")))  # one date
    return found


def metrics(spark: SparkSession, path: str, found: DataFrame) -> DataFrame:
    """A12 of every consecutive pair from the digests and the diff alone:
    run_date, in_db, unchanged, new_ads, removed, active_total (in ads)."""
    branches = _table(spark, path, "branches", f"branch int, {_DIGEST}, run_date date")
    total = branches.groupBy("run_date").agg(F.sum("n_keys").cast("bigint").alias("active_total"))
    moved = found.groupBy("run_date").agg(F.count_if(F.col("status") == NEW).alias("new_ads"), F.count_if(F.col("status") == REMOVED).alias("removed"))
    out = total.join(moved, "run_date", "left").select("run_date", F.coalesce("new_ads", F.lit(0)).alias("new_ads"),
                                                       F.coalesce("removed", F.lit(0)).alias("removed"), "active_total")
    unchanged = F.col("active_total") - F.col("new_ads")
    return out.select("run_date", (unchanged + F.col("removed")).alias("in_db"), unchanged.alias("unchanged"), "new_ads", "removed", "active_total")
