"""Size-checked broadcast, pinning of reused intermediates, spreading of
tiny inputs.

A side is broadcast only behind a row-count check; beyond the bound the
plain join stays and Spark/AQE pick a shuffle join. The side is pinned
(written to the shared folder) first, so counting it does not recompute it
and both uses see the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import default_parallelism, scratch_path

# Default upper bound for a broadcast side (rows). Tables used with it are
# dimension-like (distinct run dates, per-partition counts).
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 64 << 20


def pin(df: DataFrame, keep: bool = False) -> DataFrame:
    """Materialise ``df`` as a parquet table in the shared checkpoint folder
    and read it back: one computation (an eager ``checkpoint()`` computes
    its input twice), lineage cut, and the rows survive executor loss
    (unlike a local checkpoint). Values of non-deterministic columns
    (partition id, position) are stored as data, so every later use sees
    the same ones. ``keep``: the table outlives a ``scratch_scope``."""
    spark = df.sparkSession
    path = scratch_path(spark, "pin", keep)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast hint when ``df`` has at most ``max_rows`` rows and these take
    at most ``BROADCAST_MAX_BYTES`` by their column widths (strings at 64
    bytes); ``df`` should already be pinned (see ``pin``) so the count is cheap."""
    width = sum(64 if f.dataType.simpleString() in ("string", "binary") else 16 for f in df.schema.fields)
    rows = min(max_rows, BROADCAST_MAX_BYTES // width)
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a few-partition input (a small file, a single row group) over
    the cores before heavy per-row work (regex parsing, rendering). A no-op
    for any input that already has enough partitions, i.e. every large one,
    so it never adds a shuffle at scale."""
    target = min_partitions or default_parallelism(df.sparkSession)
    try:
        current = df.rdd.getNumPartitions()   # planning only, no job
    except Exception:  # noqa: BLE001 - no RDD access (Spark Connect): leave as is
        return df
    return df.repartition(target) if current < target else df
