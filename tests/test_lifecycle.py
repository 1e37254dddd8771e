import datetime as dt

import pytest
from pyspark.sql import functions as F

from adlens.operators import lifecycle as L
from adlens.plans import adapters as A
from adlens.plans import daily as D
from support import SF_SMALL

D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)


def ads_from_keys(spark, rows):
    """Clean ads from (key, run_date, pub_date, price) tuples."""
    df = spark.createDataFrame(rows, "k string, run_date date, pub_date date, price bigint")
    return df.select(
        F.concat(F.lit("https://ss.lv/msg/lv/real-estate/flats/r/c/"), F.col("k"), F.lit(".html")).alias("url"),
        F.col("k").alias("url_hash"), F.lit(2).alias("room_count"), F.lit(5).alias("house_floors"),
        F.lit(3).alias("apt_floor"), F.col("price").alias("price_eur"),
        F.lit(50).cast("decimal(10,2)").alias("size_sqm"),
        (F.col("price") / 50).cast("decimal(10,2)").alias("sqm_price_eur"),
        F.concat(F.lit("Iela "), F.col("k")).alias("street"), "pub_date", "run_date")


def test_snapshot_diff_and_metrics(spark):
    today = spark.createDataFrame([("b",), ("c",), ("d",), ("d",)], "url_hash string")
    prev = spark.createDataFrame([("a",), ("b",), ("c",)], "url_hash string")
    st = {r["url_hash"]: (r["status"], r["n_today"]) for r in L.snapshot_diff(today, prev).collect()}
    assert st == {"a": ("removed", 0), "b": ("still_listed", 1), "c": ("still_listed", 1), "d": ("new", 2)}
    m = L.diff_metrics(L.snapshot_diff(today, prev)).first().asDict()
    assert m == {"scraped": 4, "in_db": 3, "unchanged": 2, "new_ads": 2, "removed": 1}   # Q11: duplicates counted
    assert L.new_keys(today, prev).count() == 2 and L.removed_keys(today, prev).count() == 1
    assert L.still_listed(today, prev).count() == 2


def test_step_semantics(spark):
    prev_rows = [("a", D1, D1, 100000), ("b", D1, dt.date(2023, 12, 1), 200000)]
    store_prev = L.lifecycle_step(spark.createDataFrame([], "url_hash string, room_count int, house_floors int, "
                                                        "apt_floor int, price int, sqm int, sqm_price int, "
                                                        "apt_address string, list_date date, days_listed int, view_count int"),
                                  ads_from_keys(spark, prev_rows), D1)
    listed1 = store_prev.listed_next.cache()
    assert {r["url_hash"]: r["days_listed"] for r in listed1.collect()} == {"a": 0, "b": 31}
    # day 2: b changes price (not picked up, Q19), a disappears, c is new twice (last wins)
    today = ads_from_keys(spark, [("b", D2, dt.date(2023, 12, 1), 150000),
                                  ("c", D2, dt.date(2024, 1, 2), 1), ("c", D2, dt.date(2024, 1, 2), 2)])
    step = L.lifecycle_step(listed1, today, D2)
    nxt = {r["url_hash"]: r for r in step.listed_next.collect()}
    assert nxt["b"]["price"] == 200000 and nxt["b"]["days_listed"] == 32 and nxt["b"]["list_date"] == dt.date(2023, 12, 1)
    assert nxt["c"]["price"] == 2                                       # W3: last row per key
    rem = step.removed_delta.collect()
    assert [(r["url_hash"], r["removed_date"], r["days_listed"], r["listed_date"]) for r in rem] == [("a", D2, 0, D1)]
    m = step.metrics.first()
    assert (m["scraped"], m["in_db"], m["unchanged"], m["new_ads"], m["removed"], m["active_total"]) == (3, 2, 1, 2, 1, 2)
    tracked = L.lifecycle_step(listed1, today, D2, track_price=True)
    assert {r["url_hash"]: r["price"] for r in tracked.listed_next.collect()}["b"] == 150000
    for s in (store_prev, step, tracked):
        s.joined.unpersist()


def test_three_day_scenario(spark, tmp_dir):
    # 50 ads, then 48 of them, then those 48 and 4 new: removed 0/2/0, new 50/0/4
    rows = [(f"k{i}", D1, D1, 1000 + i) for i in range(50)]
    rows += [(f"k{i}", D2, D1, 1000 + i) for i in range(48)]
    rows += [(f"k{i}", D3, D1, 1000 + i) for i in range(48)] + [(f"n{i}", D3, D3, 5) for i in range(4)]
    store = D.StateStore(tmp_dir + "/state")
    out = D.run_days(spark, store, ads_from_keys(spark, rows))
    assert set(out.values()) == {"done"}
    m = {r["run_date"]: r for r in D.read_metrics(spark, store).collect()}
    assert [(m[d]["new_ads"], m[d]["removed"], m[d]["active_total"]) for d in (D1, D2, D3)] == [(50, 0, 50), (0, 2, 48), (4, 0, 52)]
    assert m[D3]["removed_total"] == 2
    assert D.read_removed(spark, store).count() == 2
    assert D.read_listed(spark, store).count() == 52
    # ST3: a second run of the same date is skipped; a forced rerun gives the same state
    assert D.run_day(spark, store, ads_from_keys(spark, rows[-52:]), D3) == "skipped"
    before = sorted(map(tuple, D.read_listed(spark, store).collect()))
    assert D.run_day(spark, store, ads_from_keys(spark, [r for r in rows if r[1] == D3]), D3, force=True) == "done"
    assert sorted(map(tuple, D.read_listed(spark, store).collect())) == before
    assert D.read_removed(spark, store).count() == 2
    with pytest.raises(D.LateSnapshot):
        D.run_day(spark, store, ads_from_keys(spark, rows[:50]), D1 - dt.timedelta(days=1))
    empty = ads_from_keys(spark, [("x", D3, D3, 1)]).where("false")
    assert D.run_day(spark, store, empty, D3 + dt.timedelta(days=1)) == "empty"     # V3: state untouched
    assert D.last_committed(spark, store) == D3


def test_iterated_step_equals_backfill(spark, tmp_dir):
    """W4 property: running J4 day after day gives the same open ads and
    removal history as the one-job gaps-and-islands backfill."""
    snaps = A.snapshots_from_events(spark.read.parquet(f"{SF_SMALL}/events.parquet")).cache()
    ads = snaps.select(F.col("ad_key").cast("string").alias("k"), "run_date",
                       F.col("run_date").alias("pub_date"), F.lit(1000).cast("bigint").alias("price"))
    store = D.StateStore(tmp_dir + "/state")
    D.run_days(spark, store, ads_from_keys(spark, [tuple(r) for r in ads.collect()]))
    life = L.lifecycle_backfill(snaps)
    open_bf = sorted((str(r["ad_key"]), r["list_date"], r["days_listed"])
                     for r in life.where("removed_date is null").collect())
    open_it = sorted((r["url_hash"], r["list_date"], r["days_listed"]) for r in D.read_listed(spark, store).collect())
    assert open_bf == open_it and len(open_bf) > 0
    rem_bf = sorted((str(r["ad_key"]), r["list_date"], r["removed_date"], r["days_listed"])
                    for r in life.where("removed_date is not null").collect())
    rem_it = sorted((r["url_hash"], r["listed_date"], r["removed_date"], r["days_listed"])
                    for r in D.read_removed(spark, store).collect())
    assert rem_bf == rem_it and len(rem_bf) > 0
    # and the per-day metrics equal the all-pairs diff
    status = L.run_metrics_from_status(L.daily_status(snaps))
    a = sorted((r["run_date"], r["new_ads"], r["removed"], r["unchanged"]) for r in status.collect())
    b = sorted((r["run_date"], r["new_ads"], r["removed"], r["unchanged"]) for r in D.read_metrics(spark, store).collect())
    snaps.unpersist()
    assert a == b


def test_last_per_key_hot_key(spark):
    # one key holds most rows: the aggregate keeps one row per key
    rows = [(1, i, f"e{i}") for i in range(2000)] + [(2, 5, "x"), (2, 7, "y")]
    df = spark.createDataFrame(rows, "user_id int, ts int, ev string")
    out = {r["user_id"]: (r["ts"], r["ev"]) for r in L.last_per_key(df, "user_id", ["ts"]).collect()}
    assert out == {1: (1999, "e1999"), 2: (7, "y")}


def test_run_report_entry_a(spark, tmp_dir):
    import os
    from support import RAW_REPORT
    from adlens.operators import report as RP
    inbox = os.path.join(tmp_dir, "in")
    os.makedirs(inbox)
    with open(os.path.join(inbox, "report-2024-11-09.txt"), "w", encoding="utf-8") as f:
        f.write(RAW_REPORT)
    store = D.StateStore(tmp_dir + "/state")
    assert D.run_report(spark, store, inbox) == {dt.date(2024, 11, 9): "done"}
    assert D.read_listed(spark, store).count() == 4
    q = D.read_quarantine(spark, store).collect()
    assert [r["reason"] for r in q] == ["missing:Price"]
    m = D.read_metrics(spark, store)
    line = RP.run_history(m).first()
    assert line["line"] == "09.11.2024: Scraped today: 4 | In DB: 0 | Unchanged: 0 | New ads: 4 | Removed: 0"
    assert line["counts_line"] == "Active listings in DB: 4 | Removed ads in DB: 0"


def test_bucketed_store_same_state_and_no_snapshot_shuffle(spark, tmp_dir):
    import io
    from contextlib import redirect_stdout
    rows = [(f"k{i}", D1, D1, 1000 + i) for i in range(50)]
    rows += [(f"k{i}", D2, D1, 1000 + i) for i in range(3, 48)] + [("n1", D2, D2, 7)]
    plain = D.StateStore(tmp_dir + "/plain")
    bucketed = D.StateStore(tmp_dir + "/bucketed", buckets=8)
    D.run_days(spark, plain, ads_from_keys(spark, rows))
    D.run_days(spark, bucketed, ads_from_keys(spark, rows))
    for read in (D.read_listed, D.read_removed, D.read_metrics):
        assert sorted(map(tuple, read(spark, plain).collect())) == sorted(map(tuple, read(spark, bucketed).collect()))
    # a new session has an empty catalog: dropping the external table keeps
    # the files, and the next read registers it again over its folder
    before = sorted(map(tuple, D.read_listed(spark, bucketed, D2).collect()))
    spark.sql(f"DROP TABLE {bucketed.listed_table(D2)}")
    assert sorted(map(tuple, D.read_listed(spark, bucketed, D2).collect())) == before
    # the next day's join reads the bucketed snapshot without an exchange on its side
    step = L.lifecycle_step(D.read_listed(spark, bucketed, D2), ads_from_keys(spark, rows[:10]), D3)
    buf = io.StringIO()
    with redirect_stdout(buf):
        step.listed_next.explain()
    text = buf.getvalue()
    step.joined.unpersist()
    scan = [l for l in text.splitlines() if "FileScan parquet" in l and "adlens_listed" in l]
    assert scan and "SelectedBucketsCount" in scan[0]
    assert text.count("Exchange hashpartitioning") == 1      # only today's side


def test_run_report_needs_a_date(spark, tmp_dir):
    import os
    from support import RAW_REPORT
    inbox = os.path.join(tmp_dir, "in")
    os.makedirs(inbox)
    with open(os.path.join(inbox, "report.txt"), "w", encoding="utf-8") as f:
        f.write(RAW_REPORT)
    store = D.StateStore(tmp_dir + "/state")
    with pytest.raises(ValueError):
        D.run_report(spark, store, inbox)
    assert D.run_report(spark, store, inbox, run_date="2024-11-09") == {dt.date(2024, 11, 9): "done"}


def test_metrics_come_from_the_write(spark, tmp_dir):
    """run_day counts while it writes; it took 15 jobs when it counted apart."""
    rows = [(f"k{i}", D1, D1, 499_990 + i) for i in range(30)] + [(f"k{i}", D2, D1, 1) for i in range(5, 33)] + [("k7", D2, D2, 2)]
    ads = ads_from_keys(spark, rows).cache()
    store = D.StateStore(tmp_dir + "/state")
    sc = spark.sparkContext
    for d in (D1, D2):
        before = D.read_listed(spark, store).cache()
        before.count()
        sc.setJobGroup(f"run-{d}", "run_day")
        bad = ads.where((F.col("run_date") == F.lit(d)) & F.col("url_hash").isin("k8", "k99")).select("url_hash")
        today = ads.where((F.col("run_date") == F.lit(d)) & ~F.col("url_hash").isin("k8"))
        assert D.run_day(spark, store, today, d, unparsed=bad) == "done"
        assert 0 < len(sc.statusTracker().getJobIdsForGroup(f"run-{d}")) <= 10
        sc.setLocalProperty("spark.jobGroup.id", None)
        want = L.lifecycle_step(before, today, d, persist=False, unparsed=bad).metrics.first().asDict()
        got = {r["run_date"]: r for r in D.read_metrics(spark, store).collect()}[d].asDict()
        assert {k: got[k] for k in ("scraped", "in_db", "unchanged", "new_ads", "removed", "active_total")} == {
            k: want[k] for k in ("scraped", "in_db", "unchanged", "new_ads", "removed", "active_total")}
        before.unpersist()
    assert got["removed_total"] == want["removed"] == 5 and got["removed_under_cap"] == want["removed_under_cap_delta"] == 5
    ads.unpersist()
