"""Row numbering within a segment without a per-segment window.

``row_number() over (partition by segment order by …)`` sends a whole
segment to one task; with one room count holding a third of all ads that
task holds a third of the data. Instead:

1. range-partition and sort by (segment, order…) — the global sort Spark
   uses for ``orderBy``; a hot segment spans many partitions because the
   order columns split it;
2. pin the result in the shared checkpoint folder, so partition ids and
   in-partition positions are fixed for both uses below;
3. count rows per (segment, partition) — at most partitions + segments rows;
4. prefix-sum those counts per segment (a window over the small table);
5. rank = offset of (segment, partition) + position inside the partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import default_parallelism
from .sizing import bounded_broadcast, pin


def range_partitions(spark) -> int:
    """Partitions for the range split: the session's shuffle partitions, but
    at least four per core, so the count grows with the cluster."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * default_parallelism(spark))


def rank_within(df: DataFrame, segment: list[str], order: list, name: str = "rank_in_segment",
                num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 1-based row number of each row within its segment,
    ordered by ``order`` (Columns or names; make the order total with a
    unique tie-break column)."""
    n = num_partitions or range_partitions(df.sparkSession)
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    seg_cols = [F.col(c) for c in segment]
    sorted_ = (df.repartitionByRange(n, *seg_cols, *order_cols)
               .sortWithinPartitions(*seg_cols, *order_cols)
               .withColumn("_pid", F.spark_partition_id())
               .withColumn("_pos", F.monotonically_increasing_id()))
    pinned = pin(sorted_)
    firsts = pinned.groupBy(*segment, "_pid").agg(F.min("_pos").alias("_first"),
                                                  F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(*segment).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pin(firsts.withColumn("_off", F.coalesce(F.sum("_cnt").over(w), F.lit(0))).drop("_cnt"))
    o = bounded_broadcast(offsets).alias("_o")
    cond = [pinned["_pid"] == o["_pid"]] + [pinned[c].eqNullSafe(o[c]) for c in segment]
    joined = pinned.alias("_d").join(o, cond, "inner")
    rank = (F.col("_o._off") + F.col("_d._pos") - F.col("_o._first") + 1).cast("bigint")
    return joined.select(*[F.col("_d." + c) for c in df.columns], rank.alias(name))


def paginate(df: DataFrame, segment: list[str], order: list, page_size: int = 8,
             rank_name: str = "rank_in_segment") -> DataFrame:
    """Report rows in pages of ``page_size`` per segment (0-based page)."""
    ranked = rank_within(df, segment, order, rank_name)
    return ranked.withColumn("page_no", ((F.col(rank_name) - 1) / page_size).cast("bigint"))
