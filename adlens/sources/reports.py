"""Sources S1-S6, S9, S10: listing reports, CSV tables, stored pages, logs.

The raw report is read with the text source split on ``\\nhttps`` so that
every ad block is one record and a large file stays splittable across tasks
(no ordering or global state needed). Only the fallback for indented URL
lines reads whole files (``wholetext``), which needs a file to fit in a task.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import html as H

URL_START = "https"
DATE_IN_NAME_RE = r"(\d{4}-\d{2}-\d{2})"


def _run_date_col(run_date, source_file_col):
    if run_date is None:
        return F.try_to_date(F.regexp_extract(source_file_col, DATE_IN_NAME_RE, 1), "yyyy-MM-dd")
    if isinstance(run_date, str):
        run_date = _dt.date.fromisoformat(run_date)
    return F.lit(run_date)


def read_report_blocks(spark: SparkSession, path: str, run_date=None,
                       file_glob: str | None = None) -> DataFrame:
    """One record per ad block: (block, source_file, run_date).

    ``run_date`` defaults to the ``yyyy-MM-dd`` date in the file name (S4).
    CRLF is normalised; every record but a file's first lost its leading
    ``https`` to the separator and gets it back.
    """
    reader = spark.read
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    raw = reader.text(path, lineSep="\n" + URL_START)
    value = F.translate(F.col("value"), "\r\ufeff", "")   # CRLF line ends, byte-order mark
    block = F.when(value.startswith(URL_START), value).otherwise(F.concat(F.lit(URL_START), value))
    src = F.col("_metadata.file_path")
    return (raw.select(block.alias("block"), src.alias("source_file"))
            .withColumn("run_date", _run_date_col(run_date, F.col("source_file")))
            .where(F.trim(F.col("block")) != URL_START))


def read_report_blocks_wholetext(spark: SparkSession, path: str, run_date=None) -> DataFrame:
    """S1 fallback for indented URL lines: whole file per record, split
    before each line that starts (after blanks) with ``https``; ``pos`` is the
    block's position in its file (W2)."""
    raw = spark.read.text(path, wholetext=True)
    parts = F.split(F.translate(F.col("value"), "\r", ""), r"(?m)(?=^[ \t]*" + URL_START + ")")
    return (raw.select(F.col("_metadata.file_path").alias("source_file"),
                       F.posexplode(parts).alias("pos", "block"))
            .where(F.trim(F.col("block")) != "")
            .withColumn("run_date", _run_date_col(run_date, F.col("source_file"))))


def parse_blocks(blocks: DataFrame) -> DataFrame:
    """H10 over S1 output: (url, fields MAP, block, source_file, run_date)."""
    return blocks.select(H.block_url("block").alias("url"), H.block_fields("block").alias("fields"),
                         "block", "source_file", "run_date")


def read_formatted_csv(spark: SparkSession, path: str) -> DataFrame:
    """The formatted 7-column table (leading unnamed index dropped)."""
    schema = T.StructType([T.StructField("_idx", T.StringType())] + schemas.FORMATTED.fields)
    return spark.read.schema(schema).option("header", True).csv(path).drop("_idx")


def read_cleaned_csv(spark: SparkSession, path: str, with_index: bool = True) -> DataFrame:
    """S3: the cleaned 8-column table, all strings (typed later)."""
    fields = ([T.StructField("_idx", T.StringType())] if with_index else []) + schemas.CLEANED_CSV.fields
    df = spark.read.schema(T.StructType(fields)).option("header", True).csv(path)
    return df.drop("_idx") if with_index else df


def files_for_run_date(spark: SparkSession, path: str, run_date: str) -> DataFrame:
    """Listing of files whose name contains the run date (no content read)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", f"*{run_date}*")
            .load(path).select("path", "modificationTime", "length"))


def latest_file(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Newest file by modification time (ties by path); empty when none.
    Only file metadata is read, never the content column."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return (reader.load(path).select("path", "modificationTime", "length")
            .orderBy(F.desc("modificationTime"), F.desc("path")).limit(1))


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """Typed empty table for missing input."""
    return spark.createDataFrame([], schema)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Stored pages (page_id, url, html)."""
    return spark.read.parquet(path)


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Worker log lines with file name."""
    return spark.read.text(path).select(F.col("value").alias("line"),
                                        F.col("_metadata.file_path").alias("source_file"))
