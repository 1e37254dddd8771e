"""Reads on any date, digest trees, daily states and positions."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from adlens.operators import asof, digest, quality, states
from adlens.operators import lifecycle as L
from adlens.operators import stats as ST
from adlens.plans import adapters as A
from adlens.sources import positions as P
from adlens.sources import reports as R
from support import RAW_REPORT, SF_SMALL


@pytest.fixture(scope="module")
def snapshots(spark):
    return A.snapshots_from_events(spark.read.parquet(f"{SF_SMALL}/events.parquet")).cache()


def test_open_on_equals_the_daily_status(spark, snapshots):
    got = asof.open_on(L.lifecycle_backfill(snapshots), snapshots).select("ad_key", "run_date")
    want = L.daily_status(snapshots).where("status <> 'removed'").select("ad_key", "run_date")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() > 100


def test_open_on_any_periods(spark):
    rng = random.Random(1)
    day = lambda n: dt.date(2023, 11, 20) + dt.timedelta(days=n)
    periods = [(k, day(s := rng.randrange(300)), None if rng.random() < 0.2 else day(s + rng.randrange(120))) for k in range(150)]
    periods += [(200, None, day(3)), (201, day(5), day(5)), (202, day(-400), None)]
    dates = [day(n) for n in rng.sample(range(-20, 320), 25)] + [None, day(5), day(5)]
    df = spark.createDataFrame(periods, "k int, list_date date, removed_date date").withColumn("run_date", F.lit("own"))
    asked = spark.createDataFrame([(d,) for d in dates], "run_date date")
    found = asof.open_on(df, asked)
    want = sorted((k, d) for k, s, e in periods if s for d in {x for x in dates if x} if s <= d and (e is None or d < e))
    assert sorted((r["k"], r["run_date"]) for r in found.collect()) == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "BroadcastHashJoin [_month" in plan
    assert asof.open_on(df, asked.where("false")).count() == 0 == asof.open_on(df.where("false"), asked).count()


def test_digest_diff_equals_the_snapshot_diff(spark, snapshots, tmp_dir):
    doubled = snapshots.unionByName(snapshots.where("ad_key % 3 = 0"))      # repeated rows of a key
    digest.write_snapshots(doubled, tmp_dir + "/d", 4, "ad_key", fan=2)
    found = digest.diff(spark, tmp_dir + "/d", "bigint")
    want = L.daily_status(snapshots).where("status <> 'still_listed'")
    assert sorted((r["key"], r["run_date"], r["status"]) for r in found.collect()) == sorted(
        (r["ad_key"], r["run_date"], r["status"]) for r in want.collect())
    metrics = digest.metrics(spark, tmp_dir + "/d", found).select("run_date", "in_db", "unchanged", "new_ads", "removed", "active_total")
    plain = L.run_metrics_from_status(L.daily_status(snapshots)).select(metrics.columns)
    assert sorted(map(tuple, metrics.collect())) == sorted(map(tuple, plain.collect()))


def test_unchanged_leaves_are_not_read(spark, tmp_dir):
    d1, d2, d3 = (dt.date(2024, 1, i) for i in (1, 2, 3))
    first = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("url_hash"))
    second = first.where("url_hash not in ('k7', 'k70', 'k700')").union(spark.createDataFrame([("new1",), ("new2",)], "url_hash string"))
    for d, rows in ((d1, first), (d2, second), (d3, second)):
        digest.write_snapshots(rows.withColumn("run_date", F.lit(d)), tmp_dir + "/d", 64, fan=8)
    pairs = spark.createDataFrame([(d2, d1), (d3, d2)], "run_date date, prev_date date")
    leaves = digest.changed_leaves(spark, tmp_dir + "/d", pairs)
    changed = {(r["run_date"], r["leaf"]) for r in leaves.collect()}
    assert 1 <= len(changed) <= 5 and {d for d, _ in changed} == {d2}
    found = digest.diff(spark, tmp_dir + "/d", pairs=pairs)
    assert sorted((r["key"], r["status"]) for r in found.collect()) == [
        ("k7", "removed"), ("k70", "removed"), ("k700", "removed"), ("new1", "new"), ("new2", "new")]
    # the rows scans are pruned by the changed leaves before they read
    assert found._jdf.queryExecution().executedPlan().toString().count("dynamicpruning") >= 2
    # a snapshot without any ad
    assert digest.diff(spark, tmp_dir + "/d", pairs=pairs.where("false")).count() == 0


def test_daily_states_merge(spark, tmp_dir):
    rng = random.Random(2)
    days = [dt.date(2024, 1, 25) + dt.timedelta(days=i) for i in range(15)]
    rows = [(rng.choice(days), rng.choice(["1", "2", None]), rng.randrange(1, 10**6) / 100, rng.randrange(10, 200) / 2, f"s{rng.randrange(300)}")
            for _ in range(20_000)] + [(days[0], "3", None, None, None)]
    ads = spark.createDataFrame(rows, "d date, seg string, price double, size double, street string").cache()
    ads = ads.withColumn("price", F.col("price").cast("decimal(18,2)"))
    make = lambda df: states.daily_states(df, "d", "seg", "price", "size", "street")
    root = tmp_dir + "/states"
    assert states.read_states(spark, root).count() == 0
    states.write_states(make(ads.where(F.col("d") <= F.lit(days[9]))), root)
    states.write_states(make(ads.where(F.col("d") >= F.lit(days[8]))), root)      # two days again, months kept
    lo, hi = days[3], days[12]
    part = states.read_states(spark, root, lo, hi)
    whole = states.merged(part).cache()
    inside = ads.where(F.col("d").between(F.lit(lo), F.lit(hi)))
    want = {r["seg"]: r for r in ST.price_stats(inside, "seg", "price").collect()}
    got = {r["segment"]: r for r in states.price_stats(whole).collect()}
    assert set(got) == set(want) and len(want) == 3
    for k, r in got.items():
        assert [r[c] for c in ("ad_count", "min_price", "max_price", "price_range", "avg_price")] == [
            want[k][c] for c in ("ad_count", "min_price", "max_price", "price_range", "avg_price")]
    values = {}
    for d, seg, price, size, street in rows:
        if lo <= d <= hi and price is not None:
            values.setdefault(seg, []).append((price, size, street))
    for r in states.quantiles(whole, [0.1, 0.5, 0.9]).collect():
        own = sorted(v[0] for v in values[r["segment"]])
        for rank, q in zip((0.1, 0.5, 0.9), r["quantiles"]):
            assert abs(sum(v <= q for v in own) / len(own) - rank) < 0.02
    for r in states.equi_depth_ranges(whole, 4).collect():
        own = [v[1] for v in values[r["segment"]]]
        assert abs(sum(r["from_value"] <= v <= r["to_value"] for v in own) / len(own) - 0.25) < 0.05
    for r in states.distinct_count(whole).collect():
        assert abs(r["distinct_values"] - len({v[2] for v in values[r["segment"]]})) < 20
    # a group without values, and every day by itself
    last = states.merged(states.read_states(spark, root, days[0], days[0]), ["day", "segment"])
    nothing = states.quantiles(last, [0.5], by=["day", "segment"]).where("segment = '3'").collect()
    assert [r["quantiles"] for r in nothing] == [None]
    assert part.where("month < '2024-01'").inputFiles() is not None


def _report(n):
    rng = random.Random(n)
    blocks = []
    for i in range(n):
        lines = [f" \thttps://ss.lv/msg/lv/real-estate/flats/r/c/p{i}.html", f" Istabas:>{i % 5 + 1}", f" Iela:><b>Iela {i}", " Platība:>50 m²",
                 " Stāvs:>1/2", f" Price:>{1000 + i} €", " Date:>01.02.2024", *[" Apraksts:>" + "ā" * rng.randrange(40)] * rng.randrange(3)]
        if i % 7 == 3:
            del lines[5]
        blocks.append("\n".join(lines))
    return "preamble https no head\n" + "\n".join(blocks) + "\n"


def test_positions_of_many_splits_equal_those_of_one(spark, tmp_dir):
    os.makedirs(tmp_dir + "/in")
    for name, n in (("a", 700), ("b", 3)):
        with open(f"{tmp_dir}/in/report-2024-02-0{n % 9 + 1}-{name}.txt", "w", encoding="utf-8") as f:
            f.write(_report(n).replace("\n", "\r\n") if name == "b" else _report(n))
    whole = sorted(map(tuple, P.read_report_lines(spark, tmp_dir + "/in").collect()))
    blocks = sorted(map(tuple, P.read_report_blocks_positions(spark, tmp_dir + "/in").collect()))
    zipped = sorted(map(tuple, quality.positional_lines(P.read_report_lines(spark, tmp_dir + "/in")).collect()))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert spark.read.text(tmp_dir + "/in").rdd.getNumPartitions() > 20
        lines = P.read_report_lines(spark, tmp_dir + "/in")
        assert sorted(map(tuple, lines.collect())) == whole
        assert sorted(map(tuple, P.read_report_blocks_positions(spark, tmp_dir + "/in").collect())) == blocks
        assert sorted(map(tuple, quality.positional_lines(lines).collect())) == zipped
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    own = [(r[0], r[1], r[2]) for r in whole if r[0].endswith("a.txt")]
    text = _report(700).splitlines()
    assert [n for _, n, _ in own] == list(range(len(text)))
    heads = 0
    for (_, n, pos), line in zip(own, text):
        heads += line.lstrip().startswith("https")
        assert pos == heads - 1
    assert len(zipped) == 600 + 3 and len(blocks) == 703     # a hundred of 700 ads have no price
    # the wholetext reader pairs the same values
    plain = quality.positional_formatted(R.read_report_blocks_wholetext(spark, tmp_dir + "/in/*a.txt")).drop("source_file")
    assert sorted(map(tuple, plain.collect())) == sorted(z[1:] for z in zipped if z[0].endswith("a.txt"))


def test_positions_of_the_common_report(spark, tmp_dir):
    with open(f"{tmp_dir}/report-2024-11-09.txt", "w", encoding="utf-8") as f:
        f.write(RAW_REPORT)
    rows = P.read_report_blocks_positions(spark, tmp_dir).orderBy("pos").collect()
    assert [r["pos"] for r in rows] == list(range(5)) and {r["run_date"] for r in rows} == {dt.date(2024, 11, 9)}
    assert "\n".join(r["block"] for r in rows) + "\n" == RAW_REPORT
