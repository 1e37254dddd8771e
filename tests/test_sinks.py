import datetime as dt
import glob
import os

from pyspark.sql import functions as F

from adlens.operators import report as RP
from adlens.sinks import writers as W

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def test_dated_copy_rerun_replaces_only_its_date(spark, tmp_dir):
    path = os.path.join(tmp_dir, "dated")
    W.write_dated(spark.createDataFrame([(1, D1), (2, D1), (3, D2)], "v int, run_date date"), path)
    W.write_dated(spark.createDataFrame([(9, D2)], "v int, run_date date"), path)   # rerun of D2
    got = sorted(map(tuple, spark.read.parquet(path).collect()))
    assert got == [(1, D1), (2, D1), (9, D2)]


def test_explicit_partition_overwrite_clears_stale_rows(spark, tmp_dir):
    root = os.path.join(tmp_dir, "removed")
    W.write_partition(spark.createDataFrame([("a", D1)], "k string, removed_date date"), root, "removed_date", D1)
    # a rerun whose delta is empty must leave the partition empty, not stale
    W.write_partition(spark.createDataFrame([], "k string, removed_date date"), root, "removed_date", D1)
    assert spark.read.schema("k string, removed_date date").parquet(root).count() == 0


def test_export_and_append_lines(spark, tmp_dir):
    lines = spark.createDataFrame([(2, "b"), (1, "a"), (3, "c")], "n int, line string")
    out = os.path.join(tmp_dir, "report")
    W.export_lines(lines, out, ["n"])
    text = "".join(open(f, encoding="utf-8").read() for f in sorted(glob.glob(out + "/part-*")))
    assert text.splitlines() == ["a", "b", "c"]
    log = os.path.join(tmp_dir, "log")
    W.append_lines(lines.where("n = 1"), log)
    W.append_lines(lines.where("n = 2"), log)
    assert sorted(r[0] for r in spark.read.text(log).collect()) == ["a", "b"]


def test_write_table_csv_header(spark, tmp_dir):
    out = os.path.join(tmp_dir, "t")
    W.write_table(spark.createDataFrame([(1, "x")], "a int, b string"), out, fmt="csv")
    assert spark.read.option("header", True).csv(out).columns == ["a", "b"]


def test_no_data_and_combined_report(spark):
    assert RP.no_data_report(spark).first()["line"] == "No data was collected during last scraping job."
    from decimal import Decimal
    ads = spark.createDataFrame(
        [("u1", "https://x/u1.html", 2, 3, 9, Decimal("40.90"), 57000, Decimal("1393.64"), "Meža iela 4", D1)],
        "url_hash string, url string, room_count int, apt_floor int, house_floors int, size_sqm decimal(10,2), "
        "price_eur bigint, sqm_price_eur decimal(10,2), street string, pub_date date")
    metrics = spark.createDataFrame([(D1, 1, 0, 0, 1, 0, 1, 0)],
                                    "run_date date, scraped bigint, in_db bigint, unchanged bigint, new_ads bigint, "
                                    "removed bigint, active_total bigint, removed_total bigint")
    rows = RP.combined_report(ads, D1, metrics).orderBy("section", F.col("segment").asc_nulls_first(), "line_no").collect()
    kinds = [r["line_kind"] for r in rows]
    assert kinds == ["total", "segment_title", "column_line", "ad", "stat", "stat", "pub_date", "pub_date", "run"]
    assert rows[4]["line"] == "2 | 1 | 57000.00 | 57000.00 | 0.00 | 57000.00"
    assert rows[5]["line"].startswith("all | 1 |")
    assert rows[-1]["line"] == "01.01.2024: Scraped today: 1 | In DB: 0 | Unchanged: 0 | New ads: 1 | Removed: 0"


def test_a_large_date_is_read_by_several_tasks(spark, tmp_dir):
    rows = spark.range(500_000).select("id", F.when(F.col("id") < 10, "2024-01-01").otherwise("2024-01-02").cast("date").alias("run_date"))
    W.write_dated(rows, tmp_dir + "/dated")
    back = spark.read.parquet(tmp_dir + "/dated")
    tasks = back.where("run_date = '2024-01-02'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks >= 3 and back.count() == 500_000
