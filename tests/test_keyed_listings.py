"""Keyed stream state gives the periods of the batch backfill."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from adlens.operators import lifecycle as L
from adlens.plans import adapters as A
from adlens.streaming import keyed_listings as K
from support import SF_SMALL
from test_lifecycle import ads_from_keys

pytest.importorskip("google.protobuf")


@pytest.fixture()
def two_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def put(df, inbox, order):
    """One more file, later than those before."""
    df.coalesce(1).write.mode("append").parquet(inbox)
    newest = [os.path.join(inbox, f) for f in os.listdir(inbox) if f.startswith("part-")]
    for path in newest:
        if os.path.getmtime(path) > 1_800_000_000 or path not in put.known:
            os.utime(path, (1_700_000_000 + 100 * order,) * 2)
            put.known.add(path)


put.known = set()


def stream(spark, schema, inbox):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(inbox)


def run(spark, schema, root, **options):
    q = K.start(spark, stream(spark, schema, root + "/in"), root + "/out", root + "/ckpt", **options)
    q.awaitTermination(400)
    assert q.exception() is None
    return q


def marker(ads, day):
    """A record far ahead moves the watermark past everything before."""
    return ads.limit(1).withColumn("run_date", F.lit(day)).withColumn("url_hash", F.lit("~end"))


def test_event_periods_out_of_order_and_restarted(spark, tmp_dir, two_partitions):
    snapshots = A.snapshots_from_events(spark.read.parquet(f"{SF_SMALL}/events.parquet")).cache()
    ads = A.ads_from_snapshots(snapshots).cache()
    day = F.datediff("run_date", F.lit(dt.date(2024, 1, 1)))
    # day 9 comes after day 11, days 19 and 20 after day 21
    cuts = [(day < 12) & (day != 9), (day == 9) | day.between(12, 18) | (day == 21), day.between(19, 20) | (day > 21)]
    for i, cut in enumerate(cuts[:2]):
        put(ads.where(cut), tmp_dir + "/in", i)
    run(spark, ads.schema, tmp_dir, lateness="3 days")
    first = spark.read.parquet(tmp_dir + "/out").count()
    put(ads.where(cuts[2]), tmp_dir + "/in", 2)
    put(marker(ads, dt.date(2024, 3, 1)), tmp_dir + "/in", 3)
    q = run(spark, ads.schema, tmp_dir, lateness="3 days")       # from the checkpoint
    assert q.lastProgress is not None
    events = spark.read.parquet(tmp_dir + "/out").where("url_hash <> '~end'")
    assert events.count() > first > 0
    got = sorted((int(r["url_hash"]), r["list_date"], r["removed_date"], r["days_listed"], r["price"]) for r in
                 K.listing_periods(events, snapshots).collect())
    prices = {(r["url_hash"], r["run_date"]): r["price_eur"] for r in ads.collect()}
    want = sorted((r["ad_key"], r["list_date"], r["removed_date"], r["days_listed"], prices[str(r["ad_key"]), r["list_date"]])
                  for r in L.lifecycle_backfill(snapshots).collect())
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(want) > 20
    # nothing new: a third start adds nothing
    n = events.count()
    run(spark, ads.schema, tmp_dir, lateness="3 days")
    assert spark.read.parquet(tmp_dir + "/out").where("url_hash <> '~end'").count() == n
    snapshots.unpersist()
    ads.unpersist()


def test_missing_runs_unparsed_and_repeated_records(spark, tmp_dir, two_partitions):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(10) if i not in (3, 4, 8)]    # no run on these
    rng = random.Random(4)
    rows = [(f"k{k}", d, d - dt.timedelta(days=rng.choice([0, 5])), rng.choice([10, 20])) for d in days for k in range(12)
            for _ in range(rng.choice([0, 1, 1, 1, 2]))]
    ads = ads_from_keys(spark, rows).withColumn("_reason", F.when(F.pmod(F.xxhash64("url_hash", "run_date"), F.lit(5)) == 0, "bad")).cache()
    put(ads.where(F.col("run_date") <= F.lit(days[3])), tmp_dir + "/in", 0)
    put(ads.where(F.col("run_date") > F.lit(days[3])), tmp_dir + "/in", 1)
    put(marker(ads, dt.date(2024, 3, 1)), tmp_dir + "/in", 2)
    run(spark, ads.schema, tmp_dir)
    events = spark.read.parquet(tmp_dir + "/out").where("url_hash <> '~end'")
    got = K.listing_periods(events, ads.select("run_date"))
    from adlens.operators import changes as C
    none = spark.createDataFrame([], "url_hash string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in K.VALUE.fields))
    batch = C.changes(none, ads.where("_reason is null"), ads.where("_reason is not null"), days, None)
    ins = sorted((r["url_hash"], r["run_date"], r["price"], r["list_date"]) for r in batch.where("op = 'insert'").collect())
    rem = sorted((r["url_hash"], r["run_date"], r["days_listed"]) for r in batch.where("op = 'remove'").collect())
    found = got.collect()
    assert sorted((r["url_hash"], r["first_date"], r["price"], r["list_date"]) for r in found) == ins and len(ins) > 10
    assert sorted((r["url_hash"], r["removed_date"], r["days_listed"]) for r in found if r["removed_date"]) == rem and len(rem) > 3
    ads.unpersist()


class Calls:
    """A handle and its value state that count what an ad asks of them."""

    def __init__(self):
        self.kept, self.timers, self.n = None, [], 0

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.n += 1
        return self.kept

    def update(self, value):
        self.n, self.kept = self.n + 1, value

    def clear(self):
        self.n, self.kept = self.n + 1, None

    def registerTimer(self, at):
        self.n += 1
        self.timers.append(at)


class At:
    def __init__(self, day):
        self.ms = day * K.DAY_MS + 1

    def getCurrentWatermarkInMs(self):
        return self.ms


def test_an_ad_reads_and_writes_its_state_once_a_batch():
    from pyspark.sql import Row
    values = dict.fromkeys(K.VALUES) | {"price": 5, "list_date": dt.date(2024, 1, 2), "days_listed": 1}
    ads, calls = K.Listings(1), Calls()
    ads.init(calls)
    start = (dt.date(2024, 1, 2) - K.EPOCH).days
    row = lambda d: Row(**values, url="u", parsed=True, day=start + d)
    assert list(ads.handleInputRows(("a",), iter([row(d) for d in (1, 0, 3, 2, 7)]), None)) == []
    assert calls.n == 3 and calls.timers == [start * K.DAY_MS + 1]      # read, timer, write; not per day
    calls.n = 0
    events = list(ads.handleExpiredTimer(("a",), At(start + 5), None))
    assert [(e["op"], e["run_date"], e["price"], e["days_listed"]) for e in events] == [
        (K.INSERT, dt.date(2024, 1, 2), 5, 1), (K.REMOVE, dt.date(2024, 1, 6), 5, 3)]
    assert calls.n == 3 and calls.timers[-1] == (start + 7) * K.DAY_MS + 1
    list(ads.handleInputRows(("a",), iter([row(6)]), None))             # a date before the one waited for
    assert calls.timers[-1] == (start + 6) * K.DAY_MS + 1
    events = list(ads.handleExpiredTimer(("a",), At(start + 9), None))
    assert [(e["op"], e["run_date"]) for e in events] == [(K.INSERT, dt.date(2024, 1, 8)), (K.REMOVE, dt.date(2024, 1, 10))]
    assert calls.kept is None and list(ads.handleExpiredTimer(("a",), At(start + 9), None)) == []
