"""The corpus pipeline: documents to token shards in five stages.

Every stage gets its predecessor's rows as a DataFrame of the columns of
documents and returns its own; ``run`` writes each result as Parquet under the
shared folder and reads it back.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import functions as F

from adlens.llm import decontaminate, langid, mixing, neardup, queries, tokens_out
from adlens.operators.sizing import bounded_broadcast, pin
from adlens.session import apply_batch_rows, scratch_path

#: Similarity from which two documents count as near duplicates, in percent.
NEAR = 80


def in_small_batches(stage):
    """The stage, its texts passed to Python in batches of fewer rows."""
    @wraps(stage)
    def run_stage(spark, docs, sf_dir):
        apply_batch_rows(spark)
        return stage(spark, docs, sf_dir)
    return run_stage


@in_small_batches
def language(spark, docs, sf_dir):
    """Keep the documents whose language is identified. The model learns from
    the labelled ones among three quarters of them."""
    model = langid.fit(docs.where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) != 2))
    return langid.keep_identified(docs, model)


@in_small_batches
def near_duplicates(spark, docs, sf_dir):
    """Keep one document of each near-duplicate group, the smallest doc_id;
    rows that repeat a doc_id count as one document. Rows without a doc_id
    are judged one by one, as the operator does."""
    found = neardup.near_duplicates(docs, NEAR, 100, fingerprints=True)
    gone = pin(found.where(~F.col("kept")).select("doc_id").distinct())
    rows = docs.join(bounded_broadcast(gone, neardup.BROADCAST_ROWS), "doc_id", "left_anti").select(docs.columns)
    twice = found.where("kept and doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count()
    if found.where("doc_id is null").limit(1).count() == 0:
        return rows.dropDuplicates(["doc_id"]) if twice else rows
    named = rows.where("doc_id is not null")
    place = pin(docs.where("doc_id is null").withColumn("_row", F.monotonically_increasing_id()))
    sets = neardup.documents_sets(place.withColumn("doc_id", F.col("_row"))).withColumnRenamed("doc_id", "_row")
    copies = found.where("doc_id is null and not kept").select("n_shingles", "f1", "f2").distinct()
    taken = pin(sets.join(copies, ["n_shingles", "f1", "f2"], "left_semi").select("_row"))
    left = place.join(bounded_broadcast(taken, neardup.BROADCAST_ROWS), "_row", "left_anti").select(docs.columns)
    return (named.dropDuplicates(["doc_id"]) if twice else named).unionByName(left)


@in_small_batches
def benchmark(spark, docs, sf_dir):
    """Drop the documents that hold an item of the benchmark."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@in_small_batches
def mix(spark, docs, sf_dir):
    """Repeat or leave out documents until every source has its target."""
    return mixing.mix(docs)


@in_small_batches
def tokens(spark, docs, sf_dir):
    """Write the ids of every document to shards and read these back."""
    path = scratch_path(spark, "tokens")
    tokens_out.write_shards(docs, path, tokens_out.load_tokenizer(queries.tokenizer_file()))
    return tokens_out.read_shards(spark, path)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("benchmark", benchmark), ("mix", mix), ("tokens", tokens)]

#: SQL cannot express these stages; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The last stage's rows for the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = pin(stage(spark, docs, sf_dir))
    return docs
