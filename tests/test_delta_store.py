"""The change log gives the snapshot store's state for every date."""

import datetime as dt
import os
import random
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.operators import changes as C
from adlens.operators import lifecycle as L
from adlens.plans import adapters as A
from adlens.plans import daily as D
from adlens.plans import delta_store as DS
from support import RAW_REPORT, SF_SMALL
from test_lifecycle import ads_from_keys

DAYS = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(6)]


def tagged(ads, bad=None):
    names = DS.ARRIVED.fieldNames()
    rows = ads.withColumn("_reason", F.lit(None).cast("string") if bad is None else F.when(bad, "bad_floor"))
    for f in DS.ARRIVED.fields:
        if f.name not in rows.columns:
            rows = rows.withColumn(f.name, F.lit(None).cast(f.dataType))
    return rows.select(names)


def rows_of(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=str)


def same_state(spark, log, snapshots):
    for d in DS.manifest(spark, log).dates():
        assert rows_of(DS.read_open(spark, log, d)) == rows_of(D.read_listed(spark, snapshots, d)), d
    assert rows_of(DS.read_removed(spark, log)) == rows_of(D.read_removed(spark, snapshots))
    assert rows_of(DS.read_metrics(spark, log)) == rows_of(D.read_metrics(spark, snapshots))


def random_days(seed, days=6, keys=25):
    """(key, run date, publication date, price): ads that come, go, come back,
    appear twice a day and change their price."""
    rng = random.Random(seed)
    rows, here = [], set()
    for d in DAYS[:days]:
        here = {k for k in range(keys) if rng.random() < (0.8 if k in here else 0.25)}
        for k in here:
            for _ in range(1 + (rng.random() < 0.1)):
                rows.append((f"k{k}", d, d - dt.timedelta(days=rng.choice([0, 0, 0, 3, 40])), rng.choice([1000, 2000, 600_000]) + k))
    return rows


def test_every_event_date(spark, tmp_dir):
    """All dates read from the log equal the listing periods on these dates
    (test_iterated_step_equals_backfill holds the snapshot store to the same)."""
    snapshots = A.snapshots_from_events(spark.read.parquet(f"{SF_SMALL}/events.parquet")).cache()
    rows = tagged(A.ads_from_snapshots(snapshots))
    dates = sorted(r["run_date"] for r in snapshots.select("run_date").distinct().collect())
    assert len(dates) == 30
    log = DS.DeltaStore(tmp_dir + "/log", 4)
    for i, cut in enumerate((dates[:10], dates[10:11], dates[11:20], dates[20:])):
        assert set(DS.deliver(spark, log, rows.where(F.col("run_date").isin(cut)), f"b{i}")) == set(cut)
    assert len(DS.manifest(spark, log).of(DS.BASE)) > 1
    life = [tuple(r) for r in L.lifecycle_backfill(snapshots).select("ad_key", "list_date", "removed_date").collect()]
    want = sorted((d, str(k), first, (d - first).days) for k, first, gone in life for d in dates if first <= d and (gone is None or d < gone))
    every = [DS.read_open(spark, log, d).select(F.lit(d).alias("d"), "url_hash", "list_date", "days_listed") for d in dates]
    assert sorted(map(tuple, reduce(DataFrame.unionByName, every).collect())) == want
    gone = sorted((str(k), first, to) for k, first, to in life if to)
    assert sorted(map(tuple, DS.read_removed(spark, log).select("url_hash", "listed_date", "removed_date").collect())) == gone
    snapshots.unpersist()


def test_late_replaced_and_repeated_deliveries(spark, tmp_dir):
    rows = random_days(3)
    parts = {b: tagged(ads_from_keys(spark, [r for i, r in enumerate(rows) if i % 3 == b])) for b in range(3)}
    log, snapshots = DS.DeltaStore(tmp_dir + "/log", 4), D.StateStore(tmp_dir + "/snapshots")
    for b in (2, 0, 1):     # every date comes in three parts, two of them late
        DS.deliver(spark, log, parts[b], f"b{b}")
    D.apply_arrivals(spark, snapshots, parts[0].unionByName(parts[1]).unionByName(parts[2]), "all", keep_clean=False)
    same_state(spark, log, snapshots)
    before = DS.manifest(spark, log).version
    assert set(DS.deliver(spark, log, parts[0], "b0").values()) == {"skipped"} and DS.manifest(spark, log).version == before
    assert set(DS.deliver(spark, log, parts[0], "b0", force=True).values()) == {"done"}
    same_state(spark, log, snapshots)
    # a batch that replaces itself by fewer dates takes the others back
    DS.deliver(spark, log, parts[0].where(F.col("run_date") < F.lit(DAYS[3])), "b0", force=True)
    again = D.StateStore(tmp_dir + "/again")
    D.apply_arrivals(spark, again, parts[0].where(F.col("run_date") < F.lit(DAYS[3])).unionByName(parts[1]).unionByName(parts[2]), "all", keep_clean=False)
    same_state(spark, log, again)
    assert DS.read_clean(spark, log, DAYS[1]).count() == D.read_arrivals(spark, again).where(F.col("run_date") == F.lit(DAYS[1])).count()


def test_unparsed_records(spark, tmp_dir):
    rows = random_days(5)
    ads = ads_from_keys(spark, rows)
    bad = F.pmod(F.xxhash64("url_hash", "run_date"), F.lit(4)) == 0
    log, snapshots = DS.DeltaStore(tmp_dir + "/log"), D.StateStore(tmp_dir + "/snapshots")
    for lo, hi in ((0, 2), (2, 3), (3, 6)):
        DS.deliver(spark, log, tagged(ads, bad).where(F.col("run_date").isin(DAYS[lo:hi])), f"b{lo}")
    D.apply_arrivals(spark, snapshots, tagged(ads, bad), "all", keep_clean=False)
    same_state(spark, log, snapshots)
    assert rows_of(DS.read_quarantine(spark, log)) == rows_of(D.read_quarantine(spark, snapshots))
    assert DS.read_quarantine(spark, log).count() > 0


def test_tracked_prices(spark, tmp_dir):
    ads = ads_from_keys(spark, random_days(7))
    log, snapshots = DS.DeltaStore(tmp_dir + "/log", 0), D.StateStore(tmp_dir + "/snapshots")
    DS.deliver(spark, log, tagged(ads).where(F.col("run_date").isin(DAYS[:3])), "a", track_price=True)
    DS.deliver(spark, log, tagged(ads).where(~F.col("run_date").isin(DAYS[:3])), "b", track_price=True)
    for d in DAYS[:6]:
        D.run_day(spark, snapshots, ads.where(F.col("run_date") == F.lit(d)), d, track_price=True)
    same_state(spark, log, snapshots)
    assert DS.manifest(spark, log).of(C.REFRESH)


def _bytes(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_writes_follow_the_churn(spark, tmp_dir):
    n = 20_000
    first = spark.range(n).select(F.concat(F.lit("k"), "id").alias("k"))
    def ads(day, keys):
        base = ads_from_keys(spark, [("x", day, day, 5)]).drop("url_hash", "url", "street")
        return tagged(keys.crossJoin(base).select("*", F.col("k").alias("url_hash"), F.concat(F.lit("https://ss.lv/msg/lv/a/b/"), "k").alias("url"),
                                                  F.sha2("k", 256).alias("street")).drop("k"))
    log, snapshots = DS.DeltaStore(tmp_dir + "/log"), D.StateStore(tmp_dir + "/snapshots")
    second = first.where("cast(substr(k, 2) as int) >= 20").union(spark.range(30).select(F.concat(F.lit("n"), "id").alias("k")))
    for day, keys in zip(DAYS, (first, second)):
        DS.deliver(spark, log, ads(day, keys), str(day))
        D.apply_arrivals(spark, snapshots, ads(day, keys), str(day), keep_clean=False)
    last = [e for e in DS.manifest(spark, log).of(C.INSERT, C.REMOVE) if e.run_date == DAYS[1]]
    assert sorted((e.kind, e.rows) for e in last) == [(C.INSERT, 30), (C.REMOVE, 20)]
    written = sum(_bytes(log.path(f"changes/part={e.part}/op={e.kind}/run_date={e.run_date}")) for e in last)
    assert written * 20 < _bytes(snapshots.listed_path(DAYS[1]))      # 50 of 20,000 ads moved
    same_state(spark, log, snapshots)


def test_a_crash_before_the_commit_changes_nothing(spark, tmp_dir, monkeypatch):
    rows = tagged(ads_from_keys(spark, random_days(1)))
    log = DS.DeltaStore(tmp_dir + "/log", 0)
    DS.deliver(spark, log, rows.where(F.col("run_date").isin(DAYS[:3])), "a")
    before = rows_of(DS.read_open(spark, log))
    with monkeypatch.context() as m:
        m.setattr(DS, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            DS.deliver(spark, log, rows.where(~F.col("run_date").isin(DAYS[:3])), "b")
    assert rows_of(DS.read_open(spark, log)) == before and DS.manifest(spark, log).dates() == DAYS[:3]
    DS.deliver(spark, log, rows.where(~F.col("run_date").isin(DAYS[:3])), "b")
    whole = DS.DeltaStore(tmp_dir + "/whole", 0)
    DS.deliver(spark, whole, rows, "all")
    assert rows_of(DS.read_open(spark, log)) == rows_of(DS.read_open(spark, whole))
    assert rows_of(DS.read_metrics(spark, log)) == rows_of(DS.read_metrics(spark, whole))


def test_compaction_reads_and_vacuum(spark, tmp_dir):
    rows = tagged(ads_from_keys(spark, random_days(2)))
    log, plain = DS.DeltaStore(tmp_dir + "/log", 0), DS.DeltaStore(tmp_dir + "/plain", 0)
    for store in (log, plain):
        DS.deliver(spark, store, rows.where(F.col("run_date").isin(DAYS[:3])), "a")
    DS.compact(spark, log)
    DS.compact(spark, log)       # nothing new to write
    assert [e.run_date for e in DS.manifest(spark, log).of(DS.BASE)] == [DAYS[2]]
    for store in (log, plain):
        DS.deliver(spark, store, rows.where(~F.col("run_date").isin(DAYS[:3])), "b")
    for d in DAYS[:6]:
        assert rows_of(DS.read_open(spark, log, d)) == rows_of(DS.read_open(spark, plain, d))
    # what a late date reads: the base and the changes behind it, nothing else
    files = DS.read_open(spark, log, DAYS[4]).inputFiles()
    assert files and all("/base/" in f or any(f"run_date={d}" in f for d in DAYS[3:5]) for f in files)
    assert DS.vacuum(spark, log, DAYS[1]) == []                # no base that early
    gone = DS.vacuum(spark, log, DAYS[4])
    assert gone and not any(os.path.exists(log.path(p)) for p in gone)
    for d in DAYS[2:6]:
        assert rows_of(DS.read_open(spark, log, d)) == rows_of(DS.read_open(spark, plain, d))
    assert rows_of(DS.read_removed(spark, log)) == rows_of(DS.read_removed(spark, plain))
    with pytest.raises(ValueError):
        DS.read_open(spark, log, DAYS[1])
    with pytest.raises(D.LateSnapshot):
        DS.deliver(spark, log, rows.where(F.col("run_date") == F.lit(DAYS[1])), "late")


def test_report_files_and_empty_store(spark, tmp_dir):
    log = DS.DeltaStore(tmp_dir + "/log")
    assert DS.read_open(spark, log).count() == DS.read_removed(spark, log).count() == DS.read_metrics(spark, log).count() == 0
    assert DS.deliver(spark, log, tagged(ads_from_keys(spark, [("a", DAYS[0], DAYS[0], 1)])).where("false"), "none") == {}
    inbox = os.path.join(tmp_dir, "in")
    os.makedirs(inbox)
    with open(os.path.join(inbox, "report-2024-11-09.txt"), "w", encoding="utf-8") as f:
        f.write(RAW_REPORT)
    day = dt.date(2024, 11, 9)
    assert DS.run_report(spark, log, inbox) == {day: "done"}
    assert DS.run_report(spark, log, inbox) == {day: "skipped"}
    assert DS.read_open(spark, log).count() == 4 and [r["reason"] for r in DS.read_quarantine(spark, log).collect()] == ["missing:Price"]
