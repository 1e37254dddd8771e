"""The daily run (J4 + K6-K10 + ST3) on a versioned parquet state store.

Layout under ``root`` (a shared folder):

    listed/run_date=D/        open ads after the run of D        (D5 snapshot)
    removed/removed_date=D/   ads removed by the run of D        (D6 delta)
    run_metrics/run_date=D/   one metrics row: the commit marker (D11)
    quarantine/run_date=D/    records that could not be parsed
    clean/run_date=D/         the day's clean ads (K2 dated copy, for reports)
    arrivals/batch=N/run_date=D/  parsed records as they arrived, per batch
    store/                    the marker that the store was set up

Publish protocol: the removed delta is written first, then the listed
snapshot, then the metrics row. A run counts as done only when its metrics
row exists, so a crash in between is repaired by running the date again;
every write overwrites an explicit partition path, so a rerun gives the
same state. A run of D always starts from the snapshot of the latest
committed date before D.

Deliveries (``apply_arrivals``) are kept by batch; a date is always applied
from the union of its batches, so a day may come as many files, and a file
that comes late rebuilds its date from the snapshot before it and then every
later date in order.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from .. import schemas
from ..operators import lifecycle as L
from ..operators.quality import is_empty
from ..operators.sizing import pin
from ..session import scratch_scope
from ..sinks.writers import write_dated, write_partition


def _date(d) -> _dt.date:
    return _dt.date.fromisoformat(d) if isinstance(d, str) else d


@dataclass(frozen=True)
class StateStore:
    """``buckets``: when set, each open-ads snapshot is written bucketed by
    ``url_hash`` into that many buckets and read back as an external
    catalog table over its folder, so the next day's join with today's ads
    does not shuffle the snapshot (only today's aggregated side moves)."""
    root: str
    buckets: int | None = None

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def listed_path(self, d) -> str:
        return f"{self.path('listed')}/run_date={_date(d).isoformat()}"

    def listed_table(self, d) -> str:
        tag = hashlib.sha1(self.root.encode()).hexdigest()[:12]
        return f"adlens_listed_{tag}_{_date(d).strftime('%Y%m%d')}"


_LISTED_DDL = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.LISTED_ADS.fields)


def write_listed(spark: SparkSession, store: StateStore, df: DataFrame, d) -> None:
    """K6/K8/K9: publish the open-ads snapshot of run date ``d``."""
    if not store.buckets:
        df.write.mode("overwrite").parquet(store.listed_path(d))
        return
    (df.write.mode("overwrite").format("parquet").bucketBy(store.buckets, "url_hash").sortBy("url_hash")
     .option("path", store.listed_path(d)).saveAsTable(store.listed_table(d)))


def _missing(e: Exception) -> bool:
    """Whether Spark says that a path does not exist (its error class)."""
    condition = getattr(e, "getCondition", None) or getattr(e, "getErrorClass", lambda: None)
    return condition() == "PATH_NOT_FOUND"


def _init(spark: SparkSession, store: StateStore) -> None:
    """Write the marker that the store exists, before its first table."""
    try:
        spark.read.schema("version int").parquet(store.path("store"))
    except AnalysisException as e:
        if not _missing(e):
            raise
        spark.range(1).select(F.lit(1).alias("version")).coalesce(1).write.mode("overwrite").parquet(store.path("store"))


def _read(spark: SparkSession, store: StateStore, table: str, schema: T.StructType) -> DataFrame:
    """A table of the store; empty while it was never written. A store that
    was set up holds all its tables from its first run on, so there a missing
    folder is an error, not an empty table."""
    try:
        return spark.read.schema(schema).parquet(store.path(table))
    except AnalysisException as e:
        if not _missing(e):
            raise
    try:
        spark.read.schema("run_date date").parquet(store.path("run_metrics"))
    except AnalysisException as e:
        if not _missing(e):
            raise
        return spark.createDataFrame([], schema)
    if table in OPTIONAL_TABLES:
        return spark.createDataFrame([], schema)
    raise FileNotFoundError(f"the store has run metrics but no {table} table under {store.root}")


# Tables that a store with committed runs need not have.
OPTIONAL_TABLES = ("quarantine", "clean", "arrivals")


def read_metrics(spark: SparkSession, store: StateStore) -> DataFrame:
    return _read(spark, store, "run_metrics", schemas.RUN_METRICS)


def read_removed(spark: SparkSession, store: StateStore) -> DataFrame:
    return _read(spark, store, "removed", schemas.REMOVED_ADS)


def read_quarantine(spark: SparkSession, store: StateStore) -> DataFrame:
    return _read(spark, store, "quarantine", schemas.QUARANTINE)


def read_clean(spark: SparkSession, store: StateStore, run_date=None) -> DataFrame:
    """The clean ads kept for a run date (all dates when None)."""
    df = _read(spark, store, "clean", schemas.CLEAN_ADS)
    return df if run_date is None else df.where(F.col("run_date") == F.lit(_date(run_date)))


def committed_before(spark: SparkSession, store: StateStore, run_date) -> _dt.date | None:
    """Latest committed run date before ``run_date`` (S11: one value)."""
    m = read_metrics(spark, store).where(F.col("run_date") < F.lit(_date(run_date)))
    row = m.agg(F.max("run_date").alias("d")).first()
    return row["d"] if row else None


def last_committed(spark: SparkSession, store: StateStore) -> _dt.date | None:
    row = read_metrics(spark, store).agg(F.max("run_date").alias("d")).first()
    return row["d"] if row else None


def is_committed(spark: SparkSession, store: StateStore, run_date) -> bool:
    return not read_metrics(spark, store).where(F.col("run_date") == F.lit(_date(run_date))).isEmpty()


def read_listed(spark: SparkSession, store: StateStore, run_date=None) -> DataFrame:
    """The open ads after the run of ``run_date`` (default: latest)."""
    d = _date(run_date) if run_date else last_committed(spark, store)
    if d is None:
        return spark.createDataFrame([], schemas.LISTED_ADS)
    if not store.buckets:
        return spark.read.schema(schemas.LISTED_ADS).parquet(store.listed_path(d))
    # (re)register the bucketed snapshot as an external table over its folder
    spark.sql(f"CREATE TABLE IF NOT EXISTS {store.listed_table(d)} ({_LISTED_DDL}) USING parquet "
              f"CLUSTERED BY (url_hash) SORTED BY (url_hash) INTO {store.buckets} BUCKETS "
              f"LOCATION '{store.listed_path(d)}'")
    return spark.table(store.listed_table(d))


class LateSnapshot(ValueError):
    """A run date before the last committed one (out-of-order input)."""


def run_day(spark: SparkSession, store: StateStore, today_ads: DataFrame, run_date,
            quarantine: DataFrame | None = None, force: bool = False,
            track_price: bool = False, keep_clean: bool = False, unparsed: DataFrame | None = None) -> str:
    """Apply one day's clean ads to the store. Returns 'done', 'skipped'
    (already committed and not forced, ST3) or 'empty' (V3: no record at all,
    state untouched). The quarantine is written before anything else.
    ``unparsed``: ``url_hash`` of the day's records that did not parse; open
    ads among them stay listed. Raises LateSnapshot for a date before the
    last committed one unless forced; a forced past date is rebuilt from its
    predecessor, and the later dates must follow (``apply_arrivals`` does)."""
    d = _date(run_date)
    runs = {r["run_date"]: r for r in read_metrics(spark, store).select("run_date", "removed_total", "removed_under_cap").collect()}  # a row per run
    if not force and d in runs:
        return "skipped"
    if runs and d < max(runs) and not force:
        raise LateSnapshot(f"{d} is before the last committed run {max(runs)}")
    if quarantine is not None:
        write_partition(quarantine.withColumn("run_date", F.lit(d)), store.path("quarantine"),
                        "run_date", d.isoformat())
    records = today_ads.select("url_hash")
    if is_empty(records if unparsed is None else records.unionByName(unparsed.select("url_hash"))):
        return "empty"
    _init(spark, store)
    prev_d = max((x for x in runs if x < d), default=None)
    listed_prev = read_listed(spark, store, prev_d) if prev_d else spark.createDataFrame([], schemas.LISTED_ADS)
    counted = Observation()
    step = L.lifecycle_step(listed_prev, today_ads, d, track_price=track_price, unparsed=unparsed, counted=counted)
    try:
        write_partition(step.removed_delta, store.path("removed"), "removed_date", d.isoformat())
        write_listed(spark, store, step.listed_next, d)
        if keep_clean:
            write_partition(today_ads.select(*schemas.CLEAN_ADS.fieldNames()).withColumn("run_date", F.lit(d)),
                            store.path("clean"), "run_date", d.isoformat())
        n, before = counted.get, runs[prev_d].asDict() if prev_d else {}
        row = (d, *[n[c] for c in ("scraped", "in_db", "unchanged", "new_ads", "removed", "active_total")],
               before.get("removed_total", 0) + n["removed"], before.get("removed_under_cap", 0) + n["removed_under_cap_delta"])
        metrics = spark.range(1).select(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schemas.RUN_METRICS.fields)])
        write_partition(metrics.coalesce(1), store.path("run_metrics"), "run_date", d.isoformat())
    finally:
        step.joined.unpersist()
    return "done"


# --- deliveries: a date is the union of its batches ---------------------------

ARRIVAL = T.StructType([*schemas.CLEAN_ADS.fields, T.StructField("source_file", T.StringType()),
                        T.StructField("_block", T.StringType()), T.StructField("_reason", T.StringType()),
                        T.StructField("batch", T.StringType())])


def read_arrivals(spark: SparkSession, store: StateStore) -> DataFrame:
    return _read(spark, store, "arrivals", ARRIVAL)


def delivered_dates(spark: SparkSession, store: StateStore) -> list[_dt.date]:
    """Run dates with arrivals (partition folders; a small list)."""
    rows = read_arrivals(spark, store).select("run_date").distinct().collect()
    return sorted(r["run_date"] for r in rows if r["run_date"] is not None)


def apply_arrivals(spark: SparkSession, store: StateStore, tagged: DataFrame, batch: str, keep_clean: bool = True) -> dict:
    """Keep one delivery (a tagged table with ``run_date``) and bring the
    state up to date: from the earliest date it holds, every date with
    arrivals is applied in order from the union of its batches. The same
    batch again replaces itself, so a replay gives the same state. Returns
    what ``run_day`` returned per date."""
    names = [f.name for f in ARRIVAL.fields if f.name != "batch"]
    _init(spark, store)
    rows = tagged.where(F.col("run_date").isNotNull()).select(*names).withColumn("batch", F.lit(batch))
    write_dated(rows, store.path("arrivals"), ["batch", "run_date"])
    kept = read_arrivals(spark, store)
    first = kept.where(F.col("batch") == batch).agg(F.min("run_date").alias("d")).first()["d"]
    if first is None:
        return {}
    out = {}
    for d in (x for x in delivered_dates(spark, store) if x >= first):
        day = kept.where(F.col("run_date") == F.lit(d))
        bad = day.where(F.col("_reason").isNotNull())
        out[d] = run_day(spark, store, day.where(F.col("_reason").isNull()).select(*schemas.CLEAN_ADS.fieldNames()), d,
                         quarantine=bad.select("source_file", F.col("_block").alias("block"), F.col("_reason").alias("reason")),
                         unparsed=bad.select("url_hash"), force=True, keep_clean=keep_clean)
    return out


def run_days(spark: SparkSession, store: StateStore, ads: DataFrame, dates: list | None = None,
             force: bool = False) -> dict:
    """Apply J4 day after day (the loop is over run dates, a small list;
    each day is a distributed job). ``ads`` carries a ``run_date`` column."""
    if dates is None:
        dates = [r["run_date"] for r in ads.select("run_date").distinct().orderBy("run_date").collect()]
    return {d: run_day(spark, store, ads.where(F.col("run_date") == F.lit(d)), d, force=force)
            for d in sorted(_date(x) for x in dates)}


def run_report(spark: SparkSession, store: StateStore, report_path: str, run_date=None,
               force: bool = False) -> dict:
    """Entry A: raw report file(s) -> blocks (S1) -> tagged ads -> the dates
    they hold (from the file names unless ``run_date`` is given). The files'
    names make up the batch, so running them again is a rerun: skipped unless
    ``force``. More files for a date, also late ones, are a batch of their
    own and add to it."""
    with scratch_scope(spark):
        tagged, batch = tagged_report(spark, report_path, run_date)
        if batch is None:
            return {_date(run_date): "empty"} if run_date is not None else {}
        before = read_arrivals(spark, store).where(F.col("batch") == batch)
        if not force and not before.isEmpty():
            dates = sorted(r["run_date"] for r in before.select("run_date").distinct().collect())
            if all(is_committed(spark, store, d) for d in dates):
                return {d: "skipped" for d in dates}
        return apply_arrivals(spark, store, tagged, batch)


def tagged_report(spark: SparkSession, report_path: str, run_date=None) -> tuple[DataFrame, str | None]:
    """Raw report file(s) as a pinned tagged table, parsed once, and the name
    of the batch that the files' names and dates make up (None: no record)."""
    from ..operators.extract import report_to_tagged_ads
    from ..sources.reports import read_report_blocks
    tagged = pin(report_to_tagged_ads(read_report_blocks(spark, report_path, run_date=run_date)))
    if run_date is None and not tagged.where(F.col("run_date").isNull()).isEmpty():
        raise ValueError("report files without a yyyy-MM-dd date in their name; pass run_date")
    names = tagged.select("source_file", "run_date").distinct().agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("source_file", "run_date").cast("decimal(38,0)")).alias("h")).first()
    if names["n"] == 0:
        return tagged, None
    return tagged, "files-" + hashlib.sha1(f"{names['n']}:{names['h']}".encode()).hexdigest()[:16]
