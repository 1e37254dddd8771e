"""Data-quality operators (V1-V7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from .extract import FORMATTED_FIELDS
from .ranking import rank_within
from .sizing import pin

CORE_LABELS = [label for _, label, _ in FORMATTED_FIELDS]


class FieldCountMismatch(ValueError):
    """V1 strict mode: the core fields do not occur equally often in a file."""


def field_counts(blocks: DataFrame) -> DataFrame:
    """V1: per source file, how often each core field occurs (URL lines
    included); ``balanced`` is true when all counts are equal."""
    counts = [F.sum(F.when(H.block_url("block").isNotNull(), 1).otherwise(0)).alias("n_url")]
    counts += [F.sum(H.label_count("block", label)).alias("n_" + name.lower())
               for name, label, _ in FORMATTED_FIELDS]
    agg = blocks.groupBy("source_file").agg(*counts)
    names = [c for c in agg.columns if c.startswith("n_")]
    return agg.withColumn("balanced", F.least(*names) == F.greatest(*names))


def check_field_counts(blocks: DataFrame, strict: bool = False) -> DataFrame:
    """V1: strict mode raises on any unbalanced file (the reference's
    behaviour); default mode returns the unbalanced files, whose incomplete
    ads are routed to quarantine by the extraction."""
    bad = field_counts(blocks).where(~F.col("balanced"))
    if strict and not bad.isEmpty():
        files = [r["source_file"] for r in bad.select("source_file").limit(20).collect()]
        raise FieldCountMismatch(f"unequal field counts in {files}")
    return bad


def positional_formatted(blocks: DataFrame) -> DataFrame:
    """V2 compatibility mode: the reference's positional zip. Per file, the
    i-th URL is paired with the i-th value of every field (``rank``), up to
    the shortest list. Needs ``pos`` (W2). Values are numbered per (file,
    field) without a window over a file, and paired by an aggregation on
    (file, rank), so files may be of any size."""
    lines = blocks.select("source_file", "pos", F.posexplode(F.split("block", "\n")).alias("_ord", "line"))
    return _zipped(lines, ["pos", "_ord"])


def positional_lines(lines: DataFrame) -> DataFrame:
    """V2 on the lines of ``sources.positions.read_report_lines``: the same
    pairs, from a file that was read in many splits."""
    return _zipped(lines, ["line_no"])


def _zipped(lines: DataFrame, order: list[str]) -> DataFrame:
    col_for = F.when(F.col("line").contains("https"), F.lit("URL"))
    for name, label, _ in FORMATTED_FIELDS:
        col_for = col_for.when(F.col("line").contains(label + ":"), F.lit(name))
    value = F.col("line")
    for src, dst in H.LABEL_RENAMES.items():
        value = F.replace(value, F.lit(src + ":"), F.lit(dst + ":"))
    keyed = lines.select("source_file", *order, col_for.alias("fld"), value.alias("v")).where("fld is not null")
    ranked = pin(rank_within(keyed, ["source_file", "fld"], order, "rank"))
    names = ["URL"] + [n for n, _, _ in FORMATTED_FIELDS]
    lists = ranked.groupBy("source_file", "fld").agg(F.max("rank").alias("n"))
    shortest = lists.groupBy("source_file").agg(F.min("n").alias("_n"), F.count(F.lit(1)).alias("_fields"))
    zipped = ranked.groupBy("source_file", "rank").agg(*[F.max(F.when(F.col("fld") == n, F.col("v"))).alias(n) for n in names])
    return (zipped.join(shortest.where(F.col("_fields") == len(names)), "source_file")
            .where(F.col("rank") <= F.col("_n")).select("source_file", "rank", *names))


def is_empty(df: DataFrame) -> bool:
    """V3: the empty-frame guard (one row probed, not a count)."""
    return df.isEmpty()


def column_type(df: DataFrame, column: str) -> str:
    """V5: the column's Spark type as a simple string."""
    return df.schema[column].dataType.simpleString()


def validate_snapshot(listed: DataFrame, removed: DataFrame, key: str = "url_hash") -> DataFrame:
    """V7: both tables load; row counts and duplicate open keys (must be 0)."""
    lc = listed.agg(F.count(F.lit(1)).alias("listed_rows"), F.count_distinct(key).alias("listed_keys"))
    rc = removed.agg(F.count(F.lit(1)).alias("removed_rows"))
    return lc.crossJoin(rc).withColumn("duplicate_open_keys", F.col("listed_rows") - F.col("listed_keys"))
