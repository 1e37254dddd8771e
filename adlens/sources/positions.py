"""Positions in a report that is read in many splits.

The wholetext reader knows where every block of a file stands, but needs the
file in one task. Here the file is read line by line in splits: every line is
numbered within its split (``_metadata.file_block_start`` names the split), the
splits' counts are added up over the file, and both sums give the line's and
the block's place in the whole file. What is ordered in one task is a split,
whose size Spark bounds, and per file one row per split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.sizing import pin
from .reports import URL_START, _run_date_col

# a line that begins a block: the address, after blanks
_HEAD = rf"^[ \t]*{URL_START}"


def read_report_lines(spark: SparkSession, path: str, run_date=None) -> DataFrame:
    """Every line with its place: (source_file, line_no, pos, line, run_date).
    ``line_no`` counts from 0 in the file, ``pos`` is the number of the block
    the line belongs to (-1 before the first one). Line ends and a byte-order
    mark are dropped."""
    raw = spark.read.text(path, lineSep="\n").select(
        F.translate("value", "\r\ufeff", "").alias("line"), F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"))
    raw = pin(raw.withColumn("head", F.col("line").rlike(_HEAD).cast("bigint")))    # the numbering below sees fixed rows
    splits = raw.groupBy("source_file", "split").agg(F.count(F.lit(1)).alias("lines"), F.sum("head").alias("heads"))
    before = Window.partitionBy("source_file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("source_file", "split", F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("lines_before"),
                            F.coalesce(F.sum("heads").over(before), F.lit(0)).alias("heads_before"))
    own = Window.partitionBy("source_file", "split").orderBy("at")
    local = raw.select("*", (F.row_number().over(own) - 1).alias("n"), F.sum("head").over(own).alias("heads"))
    return local.join(offsets, ["source_file", "split"]).select(
        "source_file", (F.col("n") + F.col("lines_before")).cast("bigint").alias("line_no"),
        (F.col("heads") + F.col("heads_before") - 1).cast("bigint").alias("pos"), "line",
        _run_date_col(run_date, F.col("source_file")).alias("run_date"))


def read_report_blocks_positions(spark: SparkSession, path: str, run_date=None) -> DataFrame:
    """S1 for indented reports of any size: (source_file, pos, block,
    run_date). Lines are put together per block, wherever the splits cut."""
    lines = read_report_lines(spark, path, run_date).where("pos >= 0")
    return lines.groupBy("source_file", "pos", "run_date").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n").alias("block"))
