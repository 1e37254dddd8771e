"""Plan-shape guards for the scale properties (pushdown, pruning, partial
aggregation, shuffle counts) and hot-key behaviour."""

import datetime as dt
import io
import os
from contextlib import redirect_stdout

from pyspark.sql import functions as F

import __spark_entry__ as ent
from adlens.operators import lifecycle as L
from support import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_date_range_and_status_reach_the_scan(spark):
    p = plan(ent.queries()["avg_year_status"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(o_orderdate" in p and "LessThan(o_orderdate" in p
    assert "EqualTo(o_orderstatus,F)" in p
    assert "ReadSchema: struct<o_orderstatus:string,o_totalprice:double,o_orderdate:timestamp_ntz>" in p


def test_price_cap_pushes_a_bound(spark):
    assert "LessThan(o_totalprice,500000.0)" in plan(ent.queries()["price_cap"](spark, SF_SMALL))


def test_column_pruning_on_stats(spark):
    p = plan(ent.queries()["price_stats"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_extendedprice:double,l_returnflag:string>" in p


def test_aggregations_combine_before_the_shuffle(spark):
    for name, partial in [("price_stats", "partial_sum"), ("dedup_last", "partial_max_by"),
                          ("distinct_links", "partial_count")]:
        p = plan(ent.queries()[name](spark, SF_SMALL))
        assert partial in p, name


def test_backfill_has_two_shuffles_and_broadcast_days(spark):
    p = plan(ent.queries()["lifecycle_final"](spark, SF_SMALL))
    shuffles = [l for l in p.splitlines() if l.strip().startswith("+- Exchange") or l.strip().startswith(":- Exchange")
                or l.strip().startswith("Exchange")]
    assert p.count("BroadcastExchange") >= 1
    assert len([l for l in p.splitlines() if "Exchange (" in l and "Broadcast" not in l]) <= 2, shuffles


def test_step_with_a_hot_key(spark):
    # a third of today's rows carry one key: one open row, all rows counted
    rows = [("hot", i) for i in range(3000)] + [(f"k{i}", i) for i in range(6000)]
    today = spark.createDataFrame(rows, "url_hash string, n int").select(
        F.concat(F.lit("https://ss.lv/msg/lv/real-estate/flats/r/c/"), "url_hash", F.lit("-"), F.col("n").cast("string"),
                 F.lit(".html")).alias("url"),
        "url_hash", F.lit(1).alias("room_count"), F.lit(2).alias("house_floors"), F.lit(1).alias("apt_floor"),
        (F.col("n") + 1000).cast("bigint").alias("price_eur"), F.lit(40).cast("decimal(10,2)").alias("size_sqm"),
        F.lit(25).cast("decimal(10,2)").alias("sqm_price_eur"), F.lit("Iela 1").alias("street"),
        F.lit(dt.date(2024, 1, 1)).alias("pub_date"))
    empty = spark.createDataFrame([], "url_hash string, room_count int, house_floors int, apt_floor int, price int, "
                                      "sqm int, sqm_price int, apt_address string, list_date date, days_listed int, "
                                      "view_count int")
    step = L.lifecycle_step(empty, today, dt.date(2024, 1, 2))
    try:
        assert step.listed_next.count() == 6001
        m = step.metrics.first()
        assert (m["scraped"], m["new_ads"], m["active_total"]) == (9000, 9000, 6001)
        hot = step.listed_next.where("url_hash = 'hot'").first()
        last = max(range(3000), key=lambda i: f"hot-{i}.html")   # last by (pub_date, url) as strings
        assert hot["price"] == 1000 + last
    finally:
        step.joined.unpersist()


def test_queries_are_listed_without_a_session():
    import subprocess
    import sys
    code = "import __spark_entry__ as e; print(len(e.queries()) >= len(e.oracle_sql()) > 80)"
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    assert out.stdout.strip() == "True", out.stderr[-500:]
