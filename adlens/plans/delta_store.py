"""Open ads as a log of daily changes (K6, K8, K9, K11, S7, S8, S11, ST3).

``plans.daily`` writes a whole snapshot per run date. Here a run date writes
what it changed only, so upkeep costs what the day moved, and every date can
still be read. Under ``root`` (a shared folder):

    arrivals/part=T/run_date=D/       records as one delivery brought them
    changes/part=T/op=O/run_date=D/   inserts, refreshes, removals of a date
    base/part=T/                      all ads open after some date (compaction)
    manifest/version=N/               what counts: a row per live folder and
                                      per run date (with its metrics)

A write goes to a fresh folder T and counts from the moment the next version
of the manifest names it: that one small file is the commit, a crash before it
leaves the former state. There is one writer at a time. Open ads after a date
are the newest base up to it without the ads the later changes touch, and
those changes' last insert or refresh per ad; only folders the manifest names
for these dates are read. An ad that stays listed is not written again: its
days on the market follow from its list date (``changes.days_on``).

A delivery may hold any dates, also such as were applied before: the changes
from its first date on are then worked out anew, all of them in one job, from
the state before that date and the arrivals since. The manifest has a row per
folder and date, so it grows with the run dates, not with the ads.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators import changes as C
from ..operators.lifecycle import PRICE_CAP
from ..session import delete_path
from ..sinks.writers import write_dated
from .daily import ARRIVAL, LateSnapshot, _date, _missing

METRICS = [f.name for f in schemas.RUN_METRICS.fields if f.name != "run_date"]
ARRIVALS, BASE, RUN, FLOOR = "arrivals", "base", "run", "floor"
MANIFEST = T.StructType([T.StructField("kind", T.StringType()), T.StructField("run_date", T.DateType()), T.StructField("part", T.StringType()),
                         T.StructField("batch", T.StringType()), T.StructField("rows", T.LongType()),
                         *[T.StructField(m, T.LongType()) for m in METRICS]])
ARRIVED = T.StructType([f for f in ARRIVAL.fields if f.name != "batch"])
CHANGES = T.StructType([*[f for f in schemas.LISTED_ADS.fields], T.StructField("n_today", T.LongType()), T.StructField("n_parsed", T.LongType()),
                        T.StructField("part", T.StringType()), T.StructField("op", T.StringType()), T.StructField("run_date", T.DateType())])
#: Changed ads of a delta that are broadcast when older rows are taken out of the base.
BROADCAST_ROWS = 200_000


@dataclass(frozen=True)
class DeltaStore:
    """``compact_dates``: after so many run dates without a base the log is
    compacted, or as soon as its changes outnumber the open ads (looked at
    from the eighth date on). 0 never compacts by itself."""
    root: str
    compact_dates: int = 32

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"


@dataclass(frozen=True)
class Entry:
    """A live folder (kind arrivals, with its records that have a key as
    ``scraped``, base, insert, refresh, remove, unlisted), a run date (kind run, with its metrics), or the first date left after a
    vacuum (kind floor)."""
    kind: str
    run_date: _dt.date
    part: str | None = None
    batch: str | None = None
    rows: int = 0
    metrics: dict = field(default_factory=dict)

    def row(self) -> tuple:
        return (self.kind, self.run_date, self.part, self.batch, self.rows, *[self.metrics.get(m) for m in METRICS])


class Manifest(list):
    """The entries of one version."""
    version = 0

    def of(self, *kinds: str, after=None, to=None) -> list[Entry]:
        return [e for e in self if e.kind in kinds and (after is None or e.run_date > after) and (to is None or e.run_date <= to)]

    def dates(self) -> list[_dt.date]:
        return sorted(e.run_date for e in self.of(RUN))

    def base(self, to) -> Entry | None:
        return max(self.of(BASE, to=to), key=lambda e: e.run_date, default=None)

    def floor(self) -> _dt.date | None:
        """The first date that can be read, when others were vacuumed."""
        return max((e.run_date for e in self.of(FLOOR)), default=None)


def manifest(spark: SparkSession, store: DeltaStore) -> Manifest:
    """The newest version (a small list; two versions are kept)."""
    out = Manifest()
    schema = T.StructType([*MANIFEST.fields, T.StructField("version", T.IntegerType())])
    try:
        rows = spark.read.schema(schema).parquet(store.path("manifest")).collect()
    except AnalysisException as e:
        if not _missing(e):
            raise
        return out
    out.version = max((r["version"] for r in rows), default=0)
    out.extend(Entry(r["kind"], r["run_date"], r["part"], r["batch"], r["rows"], {m: r[m] for m in METRICS if r[m] is not None})
               for r in rows if r["version"] == out.version)
    return out


def _commit(spark: SparkSession, store: DeltaStore, entries: list[Entry], old: Manifest) -> Manifest:
    new = Manifest(sorted(entries, key=lambda e: (e.run_date, e.kind, e.batch or "", e.part or "")))
    new.version = old.version + 1
    rows = spark.createDataFrame([e.row() for e in new], MANIFEST).coalesce(1)
    rows.write.mode("overwrite").parquet(store.path(f"manifest/version={new.version}"))
    if new.version > 2:
        delete_path(spark, store.path(f"manifest/version={new.version - 2}"))
    return new


def _read(spark: SparkSession, store: DeltaStore, table: str, schema: T.StructType, paths: list[str]) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", store.path(table)).parquet(*[store.path(f"{table}/{p}") for p in paths])


def _changes(spark: SparkSession, store: DeltaStore, entries: list[Entry]) -> DataFrame:
    return _read(spark, store, "changes", CHANGES, [f"part={e.part}/op={e.kind}/run_date={e.run_date}" for e in entries if e.rows])


def _open(spark: SparkSession, store: DeltaStore, known: list[Entry], date: _dt.date | None) -> DataFrame:
    """Open ads after the run of ``date`` by the manifest entries ``known``."""
    if date is None:
        return spark.createDataFrame([], schemas.LISTED_ADS)
    log = Manifest(known)
    if (floor := log.floor()) and date < floor:
        raise ValueError(f"{date} was vacuumed; the first date left is {floor}")
    base = log.base(date)
    deltas = [e for e in log.of(C.INSERT, C.REFRESH, C.REMOVE, after=base.run_date if base else None, to=date) if e.rows]
    columns = schemas.LISTED_ADS.fieldNames()
    stored = _read(spark, store, BASE, T.StructType([*schemas.LISTED_ADS.fields, T.StructField("part", T.StringType())]),
                   [f"part={base.part}"] if base and base.rows else []).select(columns)
    if deltas:
        last = _changes(spark, store, deltas).groupBy("url_hash").agg(F.max_by(F.struct("op", *C.VALUES), "run_date").alias("r"))
        if base:
            touched = last.select("url_hash")
            if sum(e.rows for e in deltas) <= BROADCAST_ROWS:   # the manifest knows how many there are
                touched = F.broadcast(touched)
            stored = stored.join(touched, "url_hash", "left_anti")
        live = last.where(F.col("r.op") != C.REMOVE).select("url_hash", *["r." + c for c in C.VALUES])
        stored = stored.unionByName(live) if base else live
    return stored.select(*[C.days_on(F.lit(date)) if c == "days_listed" else F.col(c) for c in columns])


def read_open(spark: SparkSession, store: DeltaStore, run_date=None) -> DataFrame:
    """The ads open after the run of ``run_date`` (default: the last
    one). A date without a run has the state of the run before it."""
    log = manifest(spark, store)
    dates = [d for d in log.dates() if run_date is None or d <= _date(run_date)]
    return _open(spark, store, log, dates[-1] if dates else None)


def read_removed(spark: SparkSession, store: DeltaStore, run_date=None) -> DataFrame:
    """The removal history up to ``run_date`` (default: all of it)."""
    to = _date(run_date) if run_date else None
    rows = _changes(spark, store, manifest(spark, store).of(C.REMOVE, to=to))
    return rows.select(*[F.col({"listed_date": "list_date", "removed_date": "run_date"}.get(f, f)).alias(f)
                         for f in schemas.REMOVED_ADS.fieldNames()])


def read_metrics(spark: SparkSession, store: DeltaStore) -> DataFrame:
    """A row per run date."""
    rows = [(e.run_date, *[e.metrics[m] for m in METRICS]) for e in manifest(spark, store).of(RUN)]
    return spark.createDataFrame(rows, schemas.RUN_METRICS)


def _arrivals(spark: SparkSession, store: DeltaStore, entries: list[Entry]) -> DataFrame:
    schema = T.StructType([*ARRIVED.fields, T.StructField("part", T.StringType())])
    return _read(spark, store, "arrivals", schema, [f"part={e.part}/run_date={e.run_date}" for e in entries]).drop("part")


def read_arrivals(spark: SparkSession, store: DeltaStore, run_date=None) -> DataFrame:
    """The records as delivered, of one run date or all."""
    on = _date(run_date) if run_date else None
    return _arrivals(spark, store, [e for e in manifest(spark, store).of(ARRIVALS) if on in (None, e.run_date)])


def read_clean(spark: SparkSession, store: DeltaStore, run_date=None) -> DataFrame:
    """The clean ads of one run date or all."""
    return read_arrivals(spark, store, run_date).where(F.col("_reason").isNull()).select(schemas.CLEAN_ADS.fieldNames())


def read_quarantine(spark: SparkSession, store: DeltaStore) -> DataFrame:
    """The records that did not parse; nothing is written for it."""
    return read_arrivals(spark, store).where(F.col("_reason").isNotNull()).select(
        "source_file", F.col("_block").alias("block"), F.col("_reason").alias("reason"), "run_date")


def _run_entries(dates, arrived: dict, told: dict, before: dict, part: str) -> list[Entry]:
    """Entries of the dates: folders with rows, and each run with its metrics.
    ``told[(op, date)]`` holds rows, n_today, n_parsed and rows under the cap."""
    out, state = [], dict(before)
    for d in dates:
        ops = {op: told.get((op, d), (0, 0, 0, 0)) for op in (C.INSERT, C.REFRESH, C.REMOVE, C.UNLISTED)}
        out += [Entry(op, d, part, None, n[0]) for op, n in ops.items() if n[0]]
        new, removed = ops[C.INSERT], ops[C.REMOVE]
        unchanged = arrived[d] - new[1] - ops[C.UNLISTED][1]
        in_db = state.get("active_total", 0)
        state = {"scraped": unchanged + new[2], "in_db": in_db, "unchanged": unchanged, "new_ads": new[2], "removed": removed[0],
                 "active_total": in_db + new[0] - removed[0], "removed_total": state.get("removed_total", 0) + removed[0],
                 "removed_under_cap": state.get("removed_under_cap", 0) + removed[3]}
        out.append(Entry(RUN, d, None, None, arrived[d], state))
    return out


def deliver(spark: SparkSession, store: DeltaStore, tagged: DataFrame, batch: str, force: bool = False, track_price: bool = False) -> dict:
    """Keep one delivery of tagged records (``run_date`` set) and apply every
    date from its first one on. The same batch again is skipped, or replaces
    itself when forced. Returns 'done' or 'skipped' per date."""
    log = manifest(spark, store)
    mine = {e.run_date for e in log.of(ARRIVALS) if e.batch == batch}
    if mine and not force:
        return {d: "skipped" for d in sorted(mine)}
    part = uuid.uuid4().hex[:12]
    rows = tagged.where(F.col("run_date").isNotNull()).select(ARRIVED.fieldNames())
    write_dated(rows, store.path(f"arrivals/part={part}"))
    counts = (spark.read.schema(ARRIVED).parquet(store.path(f"arrivals/part={part}")).groupBy("run_date")
              .agg(F.count(F.lit(1)).alias("rows"), F.count("url_hash").alias("scraped")).collect())   # a row per date
    counts = [r for r in counts if r["run_date"] is not None]
    if not counts and not mine:
        return {}
    arrivals = [e for e in log.of(ARRIVALS) if e.batch != batch]
    arrivals += [Entry(ARRIVALS, r["run_date"], part, batch, r["rows"], {"scraped": r["scraped"]}) for r in counts]
    first = min(mine | {r["run_date"] for r in counts})
    if (floor := log.floor()) and first <= floor:
        raise LateSnapshot(f"{first} is not after {floor}, up to which the log was vacuumed")
    return _apply(spark, store, log, arrivals, first, track_price)


def _apply(spark, store, log: Manifest, arrivals: list[Entry], first: _dt.date, track_price: bool) -> dict:
    """Work out the changes of every date from ``first`` on and commit."""
    kept = [e for e in log if e.kind != ARRIVALS and (e.run_date < first or e.kind == FLOOR)]
    today = [e for e in arrivals if e.run_date >= first]
    dates = sorted({e.run_date for e in today})
    before = max((e for e in kept if e.kind == RUN), key=lambda e: e.run_date, default=None)
    entries = [*kept, *arrivals]
    if dates:
        rows = _arrivals(spark, store, today)
        found = C.changes(_open(spark, store, kept, before.run_date if before else None), rows.where(F.col("_reason").isNull()),
                          rows.where(F.col("_reason").isNotNull()), dates, before.run_date if before else None, track_price)
        part = uuid.uuid4().hex[:12]
        write_dated(found, store.path(f"changes/part={part}"), ["op", "run_date"])
        schema = T.StructType([f for f in CHANGES.fields if f.name != "part"])
        told = {(r["op"], r["run_date"]): (r["rows"], r["n_today"], r["n_parsed"], r["low"]) for r in
                spark.read.schema(schema).parquet(store.path(f"changes/part={part}")).groupBy("op", "run_date").agg(
                    F.count(F.lit(1)).alias("rows"), F.sum("n_today").alias("n_today"), F.sum("n_parsed").alias("n_parsed"),
                    F.count_if(F.col("price") < PRICE_CAP).alias("low")).collect()}   # a row per date and kind of change
        scraped = {d: sum(e.metrics["scraped"] for e in today if e.run_date == d) for d in dates}
        entries += _run_entries(dates, scraped, told, before.metrics if before else {}, part)
    new = _commit(spark, store, entries, log)
    _compact_if_due(spark, store, new)
    return {d: "done" for d in dates}


def _compact_if_due(spark: SparkSession, store: DeltaStore, log: Manifest) -> None:
    dates = log.dates()
    if not store.compact_dates or not dates:
        return
    base = log.base(dates[-1])
    since = [e for e in log.of(RUN) if base is None or e.run_date > base.run_date]
    changed = sum(e.rows for e in log.of(C.INSERT, C.REFRESH, C.REMOVE, after=base.run_date if base else None))
    if len(since) >= store.compact_dates or len(since) >= 8 and changed > since[-1].metrics["active_total"]:
        compact(spark, store)


def compact(spark: SparkSession, store: DeltaStore) -> None:
    """Write the open ads of the last date as a base; the changes before it
    stay for reading earlier dates until ``vacuum`` drops them."""
    log = manifest(spark, store)
    dates = log.dates()
    if not dates or (base := log.base(dates[-1])) and base.run_date == dates[-1]:
        return
    part = uuid.uuid4().hex[:12]
    _open(spark, store, log, dates[-1]).write.mode("overwrite").parquet(store.path(f"base/part={part}"))
    total = log.of(RUN, to=dates[-1])[-1].metrics["active_total"]
    _commit(spark, store, [*log, Entry(BASE, dates[-1], part, None, total)], log)


def vacuum(spark: SparkSession, store: DeltaStore, keep_from) -> list[str]:
    """Forget how to read the dates before ``keep_from`` and delete the
    folders that no version needs any more: bases and changes behind the
    newest base up to that date. Removal history, arrivals and metrics stay.
    Returns the deleted folders."""
    log = manifest(spark, store)
    base = log.base(_date(keep_from))
    if base is None:
        return []
    gone = [e for e in log if e.kind == BASE and e.run_date < base.run_date
            or e.kind in (C.INSERT, C.REFRESH, C.UNLISTED) and e.run_date <= base.run_date]
    left = [e for e in log if e not in gone and e.kind != FLOOR]
    _commit(spark, store, [*left, Entry(FLOOR, base.run_date)], log)
    paths = sorted(f"base/part={e.part}" if e.kind == BASE else f"changes/part={e.part}/op={e.kind}/run_date={e.run_date}" for e in gone)
    for p in paths:
        delete_path(spark, store.path(p))
    return paths


def run_report(spark: SparkSession, store: DeltaStore, report_path: str, run_date=None, force: bool = False) -> dict:
    """Entry A over this store: raw report files -> tagged ads -> the dates
    they hold. The batch is named by the files, so they are applied once."""
    from .daily import tagged_report
    from ..session import scratch_scope
    with scratch_scope(spark):
        tagged, batch = tagged_report(spark, report_path, run_date)
        if batch is None:
            return {_date(run_date): "empty"} if run_date is not None else {}
        return deliver(spark, store, tagged, batch, force=force)
