import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from adlens.operators import ranking as RK
from adlens.operators import report as RP
from adlens.operators import stats as ST


def test_price_stats_golden(spark):
    df = spark.createDataFrame([(1, p) for p in (100, 200, 300, 400, 500)], "room int, price bigint")
    r = ST.price_stats(df, "room", "price").first()
    assert (r["ad_count"], r["min_price"], r["max_price"], r["price_range"], r["avg_price"]) == (
        5, Decimal("100.00"), Decimal("500.00"), Decimal("400.00"), Decimal("300.00"))
    assert ST.price_stats(df.where("false"), "room", "price").count() == 0


def test_price_stats_rollup_and_rounding(spark):
    rows = [(1, 28000), (1, 29500), (2, 28000), (2, 82000), (2, 50000)]
    df = spark.createDataFrame(rows, "room int, price bigint")
    out = {(r["room"], r["is_total"]): r for r in ST.price_stats(df, "room", "price", with_total=True).collect()}
    assert out[(None, True)]["ad_count"] == 5 and out[(None, True)]["avg_price"] == Decimal("43500.00")
    assert out[(2, False)]["avg_price"] == Decimal("53333.33")
    half = spark.createDataFrame([(1, Decimal("0.12")), (1, Decimal("0.13"))], "room int, price decimal(10,2)")
    assert ST.price_stats(half, "room", "price").first()["avg_price"] == Decimal("0.13")   # Q10: half-up
    table = ST.price_stat_table(ST.price_stats(df, "room", "price", with_total=True), "room").collect()
    assert [r["Room Segment"] for r in table] == ["1", "2", "all"]


def test_value_counts_and_top(spark):
    df = spark.createDataFrame([(v,) for v in [3, 3, 1, 1, 2, None, None, None]], "v int")
    rows = [tuple(r) for r in ST.value_counts(df, "v").collect()]
    assert rows == [(1, 2), (3, 2), (2, 1), (None, 0)]     # COUNT(c) is 0 for the NULL group
    assert [tuple(r) for r in ST.value_counts(df, "v", top=2).collect()] == [(1, 2), (3, 2)]


def test_months_chronological(spark):
    dates = [dt.date(2023, 12, 1), dt.date(2023, 11, 15), dt.date(2023, 12, 20), dt.date(2024, 1, 2)]
    df = spark.createDataFrame([(d,) for d in dates], "pub_date date")
    assert [r["month_key"] for r in ST.distinct_months(df).collect()] == ["11.2023", "12.2023", "01.2024"]  # Q14
    mc = {r["month_key"]: (r["n_dates"], r["ad_count"]) for r in ST.month_counts(df).collect()}
    assert mc == {"11.2023": (1, 1), "12.2023": (2, 2), "01.2024": (1, 1)}
    lines = [r["line"] for r in RP.pub_date_report(df).orderBy("month_start", F.col("pub_date").asc_nulls_first()).collect()]
    assert lines[:3] == ["--- Month: 11.2023 ---", "Pub_date: 15.11.2023 ->  Listed add count: 1 ", "--- Month: 12.2023 ---"]


def test_share_floor_filter_street(spark):
    df = spark.createDataFrame([(1, 2, 5, "Meža iela 4"), (1, 1, 5, "Meža iela 6a"), (2, 5, 5, "Skolas 3"),
                                (3, 3, 9, "Upes 1")],
                               "room int, apt_floor int, house_floors int, street string")
    share = {r["room"]: r["pct"] for r in ST.share_of_total(df, "room").collect()}
    assert share == {1: Decimal("50.00"), 2: Decimal("25.00"), 3: Decimal("25.00")}
    assert [r["apt_floor"] for r in ST.floor_filter(df).collect()] == [2]
    names = sorted(r[0] for r in df.select(ST.street_name("street")).collect())
    assert names == ["Meža iela", "Meža iela", "Skolas", "Upes"]


def test_rank_within_equals_window_with_hot_segment(spark):
    random.seed(7)
    # segment 0 holds most rows; many equal prices inside it
    rows = [(0 if i % 10 < 7 else i % 5, random.randint(1, 20), f"h{i:05d}") for i in range(5000)]
    df = spark.createDataFrame(rows, "seg int, price int, h string")
    got = RK.rank_within(df, ["seg"], ["price", "h"], num_partitions=16)
    w = Window.partitionBy("seg").orderBy("price", "h")
    want = df.withColumn("rank_in_segment", F.row_number().over(w).cast("bigint"))
    assert got.exceptAll(want.select(got.columns)).count() == 0 and got.count() == 5000
    pages = RK.paginate(df, ["seg"], ["price", "h"], page_size=8)
    assert pages.where("rank_in_segment = 9").select("page_no").distinct().first()[0] == 1


def test_rank_within_null_segment(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), (1, 1, "c")], "seg int, price int, h string")
    got = {r["h"]: r["rank_in_segment"] for r in RK.rank_within(df, ["seg"], ["price", "h"]).collect()}
    assert got == {"a": 1, "b": 2, "c": 1}


def test_report_lines(spark):
    ads = spark.createDataFrame(
        [("u1", "https://x/u1.html", 2, 3, 9, Decimal("40.90"), 57000, Decimal("1393.64"), "Meža iela 4", dt.date(2024, 3, 1)),
         ("u2", "https://x/u2.html", 2, 1, 5, Decimal("50.00"), 45000, Decimal("900.00"), "Upes 1", dt.date(2024, 2, 1)),
         ("u3", "https://x/u3.html", 1, 2, 2, Decimal("30.00"), 30000, Decimal("1000.00"), "Parka 7", dt.date(2024, 2, 1))],
        "url_hash string, url string, room_count int, apt_floor int, house_floors int, size_sqm decimal(10,2), "
        "price_eur bigint, sqm_price_eur decimal(10,2), street string, pub_date date")
    lines = [r["line"] for r in RP.ads_by_segment(ads, dt.date(2024, 3, 1), title="=== Report {date} ===")
             .orderBy("section", F.col("segment").asc_nulls_first(), "line_no").collect()]
    assert lines[0] == "=== Report 2024-03-01 ===" and lines[1] == "Total active listings: 3"
    assert lines[2] == "1 room apartment segment:"
    assert lines[5] == "2 room apartment segment:"
    assert lines[7].startswith("  2     1/5    50.00   45000 EUR    900.00 EUR   Upes 1   01.02.2024")
    assert lines[8].endswith("u1.html [NEW]")


def test_non_numeric_rooms_come_after_numbers(spark):
    ads = spark.createDataFrame(
        [("u1", "https://x/u1.html", "2", 2, 1, 5, Decimal("50.00"), 45000, Decimal("900.00"), "Upes 1", dt.date(2024, 2, 1)),
         ("u2", "https://x/u2.html", "Citi", None, 1, 5, Decimal("50.00"), 40000, Decimal("800.00"), "Upes 2", dt.date(2024, 2, 1))],
        "url_hash string, url string, room_label string, room_count int, apt_floor int, house_floors int, "
        "size_sqm decimal(10,2), price_eur bigint, sqm_price_eur decimal(10,2), street string, pub_date date")
    lines = [r["line"] for r in RP.ads_by_segment(ads, dt.date(2024, 3, 1))
             .orderBy("section", F.col("segment").asc_nulls_first(), "line_no").collect()]
    assert lines[1] == "2 room apartment segment:" and lines[4] == "Citi room apartment segment:"
    assert lines[6].startswith("  Citi     1/5")
    table = ST.price_stat_table(ST.price_stats(ads, "room_count", "price_eur", with_total=True), "room_count").collect()
    assert [r["Room Segment"] for r in table] == ["2", "other", "all"]
