"""Structured Streaming over arriving report files (ST1-ST3).

Each arriving raw report is read block by block (the same ``\\nhttps``
record separator as the batch source), parsed with the batch operators, and
handed to ``plans.daily.apply_arrivals`` by ``foreachBatch``. The unit is the
run date: a date may come in any number of files and micro-batches, in any
order; a file that comes after later dates were committed rebuilds its date
and those after it, so nothing is dropped. The stream checkpoint records which
files were processed (ST1: each file once); a replayed micro-batch replaces
its own arrivals (ST3), so the sink is effectively exactly-once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.extract import report_to_tagged_ads
from ..operators.sizing import pin
from ..plans import daily as D
from ..plans import delta_store as DS
from ..session import scratch_scope
from ..sinks.writers import write_partition
from ..sources.reports import DATE_IN_NAME_RE, URL_START


def report_stream(spark: SparkSession, input_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """ST1: a streaming DataFrame of ad blocks (block, source_file, run_date)."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.text(input_dir, lineSep="\n" + URL_START)
    value = F.translate(F.col("value"), "\r\ufeff", "")   # CRLF line ends, byte-order mark
    block = F.when(value.startswith(URL_START), value).otherwise(F.concat(F.lit(URL_START), value))
    src = F.col("_metadata.file_path")
    return (raw.select(block.alias("block"), src.alias("source_file"))
            .withColumn("run_date", F.try_to_date(F.regexp_extract("source_file", DATE_IN_NAME_RE, 1), "yyyy-MM-dd"))
            .where(F.trim(F.col("block")) != URL_START))


def apply_batch(spark: SparkSession, store: D.StateStore | DS.DeltaStore, blocks: DataFrame, epoch_id: int | None = None,
                query_id: str | None = None) -> dict:
    """ST2: apply one micro-batch of blocks to the store. It is parsed once
    into a pinned tagged table, deleted when the batch ends. Blocks from files
    without a date in their name go to ``quarantine_undated/epoch=…``."""
    batch = f"{query_id or 'stream'}-{epoch_id}"
    with scratch_scope(spark):
        tagged = pin(report_to_tagged_ads(blocks))
        undated = tagged.where(F.col("run_date").isNull())
        if not undated.isEmpty():
            write_partition(undated.select("source_file", F.col("_block").alias("block"),
                                           F.lit("no_run_date").alias("reason"), F.lit(batch).alias("epoch")),
                            store.path("quarantine_undated"), "epoch", batch)
        if isinstance(store, DS.DeltaStore):
            return DS.deliver(spark, store, tagged, batch, force=True)
        return D.apply_arrivals(spark, store, tagged, batch)


def start(spark: SparkSession, input_dir: str, store: D.StateStore | DS.DeltaStore, checkpoint_location: str,
          available_now: bool = True, max_files_per_trigger: int | None = None):
    """Start the stream; ``available_now`` processes what is there and stops
    (the daily trigger); otherwise it polls."""
    stream = report_stream(spark, input_dir, max_files_per_trigger)

    def apply(batch, epoch):
        own = batch.sparkSession
        query = own.sparkContext.getLocalProperty("sql.streaming.queryId")
        apply_batch(spark, store, batch, epoch, query)

    writer = stream.writeStream.option("checkpointLocation", checkpoint_location).foreachBatch(apply)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 minutes")
    return writer.start()
