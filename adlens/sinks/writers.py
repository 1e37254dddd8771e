"""Sinks K1-K5, K11, K12: tables, dated copies, report text, raw reports.

Writes are idempotent: a run's outputs go to explicit partition paths that
a rerun overwrites (never appended twice).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", **options) -> None:
    """K1/K5: write a table (parquet by default; csv with header)."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    for k, v in options.items():
        w = w.option(k, v)
    w.save(path)


# A file of a few columns is one row group whatever its date holds, and a row
# group is read by one task.
ROWS_PER_FILE = 200_000


def write_dated(df: DataFrame, path: str, partition_col: str | list[str] = "run_date", fmt: str = "parquet",
                rows_per_file: int = ROWS_PER_FILE) -> None:
    """K2: dated copy of a stage output; dynamic partition overwrite makes a
    rerun of the same date replace only that date. Rows are rebalanced by the
    partition columns, so a date has few files, and adaptive execution splits
    a hot date over tasks; a file has at most ``rows_per_file`` rows, so that
    as many tasks read a date back."""
    columns = [partition_col] if isinstance(partition_col, str) else list(partition_col)
    (df.hint("rebalance", *map(F.col, columns)).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
     .option("partitionOverwriteMode", "dynamic").partitionBy(*columns).format(fmt).save(path))


def write_partition(df: DataFrame, root: str, column: str, value, fmt: str = "parquet") -> str:
    """Overwrite the explicit partition path ``root/column=value``.
    Unlike dynamic overwrite this also clears the partition when ``df`` is
    empty, so a rerun never leaves stale rows."""
    path = f"{root.rstrip('/')}/{column}={value}"
    df.drop(column).write.mode("overwrite").format(fmt).save(path)
    return path


def append_lines(lines: DataFrame, path: str, line_col: str = "line") -> None:
    """K4: append text lines."""
    lines.select(F.col(line_col).alias("value")).write.mode("append").text(path)


def export_lines(lines: DataFrame, path: str, order: list, line_col: str = "line") -> None:
    """K4 for reports: globally ordered text; part files follow the order
    (range-partitioned sort), nothing is gathered into one task."""
    lines.orderBy(*order).select(F.col(line_col).alias("value")).write.mode("overwrite").text(path)


def report_blocks(ads: DataFrame) -> DataFrame:
    """Render clean ads back into the raw report format (URL line,
    ``Label:>value`` lines, ``Price:>``, ``Date:>``), one block per ad."""
    floor = F.concat(F.col("apt_floor").cast("string"), F.lit("/"), F.col("house_floors").cast("string"),
                     F.when(F.col("has_lift"), F.lit("/lifts")).otherwise(F.lit("")))
    price = F.concat(F.lit("Price:>"), X.thousands("price_eur"), F.lit(" €"),
                     F.when(F.col("sqm_price_eur").isNotNull(),
                            F.concat(F.lit(" ("), X.thousands2("sqm_price_eur"), F.lit(" €/m²)"))).otherwise(F.lit("")))
    lines = [F.col("url"),
             F.concat(F.lit("Iela:><b>"), F.col("street")),
             F.concat(F.lit("Istabas:>"), F.col("room_label")),
             F.concat(F.lit("Platība:>"), F.col("size_sqm").cast("string"), F.lit(" m²")),
             F.concat(F.lit("Stāvs:>"), floor),
             price,
             F.concat(F.lit("Date:>"), X.format_source_date("pub_date"))]
    return ads.select(F.concat_ws("\n", *lines).alias("block"), *[c for c in ("run_date",) if c in ads.columns])


def write_cleaned_csv(ads: DataFrame, path: str) -> None:
    """K1/K3: clean ads in the reference's cleaned-CSV layout (leading index
    column, dd.MM.yyyy dates), sorted by price within each file."""
    out = ads.select(
        F.col("url_hash").alias("_idx"), F.col("url").alias("URL"), F.col("room_label").alias("Room_count"),
        F.concat_ws("/", F.col("apt_floor").cast("string"), F.col("house_floors").cast("string")).alias("Floor"),
        F.col("street").alias("Street"), X.format_source_date("pub_date").alias("Pub_date"),
        F.col("size_sqm").cast("string").alias("Size_sqm"), F.col("price_eur").cast("string").alias("Price_in_eur"),
        F.col("sqm_price_eur").cast("string").alias("SQ_meter_price"))
    out.sortWithinPartitions(F.col("Price_in_eur").cast("bigint"), "_idx").write.mode("overwrite").option("header", True).csv(path)


def write_report_files(ads: DataFrame, path: str, by_date: bool = True) -> None:
    """K12 + K2: raw report text files, one folder per run date."""
    blocks = report_blocks(ads)
    if by_date and "run_date" in blocks.columns:
        blocks.write.mode("overwrite").partitionBy("run_date").text(path)
    else:
        blocks.select("block").write.mode("overwrite").text(path)
