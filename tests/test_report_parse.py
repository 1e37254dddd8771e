import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from adlens.functions import html as H
from adlens.operators import extract as E
from adlens.operators import quality as Q
from adlens.sources import reports as R
from support import RAW_REPORT


def write_report(tmp_dir, text=RAW_REPORT, name="report-2024-11-09.txt"):
    path = os.path.join(tmp_dir, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return tmp_dir


def test_blocks_one_per_ad(spark, tmp_dir):
    blocks = R.read_report_blocks(spark, write_report(tmp_dir))
    rows = blocks.collect()
    assert len(rows) == 5
    assert all(r["block"].startswith("https://") for r in rows)
    assert {r["run_date"] for r in rows} == {dt.date(2024, 11, 9)}   # S4: date from the file name


def test_large_file_splits_without_loss(spark, tmp_dir):
    # one file of many ads read with a small split size: no block lost or doubled
    text = "".join(RAW_REPORT.replace("q1a2z", f"a{i:05d}").split("https://ss.lv/msg/lv/real-estate/flats/testa-nov/ezerpils/w3s4x")[0]
                   for i in range(3000))
    write_report(tmp_dir, text, "big-2024-11-09.txt")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        blocks = R.read_report_blocks(spark, tmp_dir)
        assert blocks.rdd.getNumPartitions() > 1
        urls = blocks.select(H.block_url("block").alias("u"))
        assert urls.count() == 3000 and urls.distinct().count() == 3000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_fields_map_and_formatted(spark, tmp_dir):
    parsed = R.parse_blocks(R.read_report_blocks(spark, write_report(tmp_dir)))
    first = parsed.where(F.col("url").endswith("q1a2z.html")).first()
    assert first["fields"]["Istabas"] == "3"
    assert first["fields"]["Iela"] == "<b>Bērzu gatve 21"
    assert first["fields"]["Sērija"] == "Jaun."
    formatted, quarantine = E.blocks_to_formatted(parsed)
    f = formatted.where(F.col("URL").endswith("q1a2z.html")).first()
    assert (f["Room_count"], f["Size_sq_m"], f["Floor"], f["Street"], f["Price"], f["Pub_date"]) == (
        "Istabas:>3", "Platiba:>71.3 m²", "Stavs:>2/6", "Iela:><b>Bērzu gatve 21",
        "Price:>88 250 € (1 237.73 €/m²)", "Date:>09.11.2024")
    q = quarantine.collect()
    assert [(r["reason"]) for r in q] == ["missing:Price"]   # r7f8v has no price line


def test_clean_ads(spark, tmp_dir):
    clean, quarantine = E.report_to_clean_ads(R.read_report_blocks(spark, write_report(tmp_dir)))
    rows = {r["url_hash"]: r for r in clean.collect()}
    assert set(rows) == {"q1a2z", "w3s4x", "e5d6c", "t9g0b"}
    b = rows["w3s4x"]
    assert (b["room_count"], b["apt_floor"], b["house_floors"], b["has_lift"]) == (4, 5, 8, True)
    assert b["street"] == "Ozolu prospekts7"
    assert b["size_sqm"] == Decimal("96.45") and b["price_eur"] == 131000 and b["sqm_price_eur"] == Decimal("1358.22")
    c = rows["e5d6c"]
    assert (c["apt_floor"], c["price_eur"]) == (1, 2450000)
    e = rows["t9g0b"]
    assert e["price_eur"] == 61300 and e["sqm_price_eur"] is None and e["street"] == "Priežu iela15"
    assert rows["q1a2z"]["pub_date"] == dt.date(2024, 11, 9) and rows["q1a2z"]["city"] == "ezerpils"
    assert quarantine.count() == 1


def test_unparseable_values_go_to_quarantine(spark, tmp_dir):
    bad = RAW_REPORT.replace("Stāvs:>2/6", "Stāvs:>augšā").replace("Date:>22.10.2024", "Date:>vakar")
    clean, quarantine = E.report_to_clean_ads(R.read_report_blocks(spark, write_report(tmp_dir, bad)))
    reasons = sorted(r["reason"] for r in quarantine.collect())
    assert reasons == ["bad_date", "bad_floor", "missing:Price"]
    assert clean.count() == 2


def test_wholetext_fallback_for_indented_report(spark, tmp_dir):
    indented = "\n".join("    " + line for line in RAW_REPORT.splitlines())
    blocks = R.read_report_blocks_wholetext(spark, write_report(tmp_dir, indented), run_date="2024-11-09")
    assert blocks.count() == 5
    assert [r["pos"] for r in blocks.orderBy("pos").collect()] == [0, 1, 2, 3, 4]
    clean, _ = E.report_to_clean_ads(blocks)
    assert clean.count() == 4


def test_field_count_check(spark, tmp_dir):
    blocks = R.read_report_blocks(spark, write_report(tmp_dir))
    bad = Q.check_field_counts(blocks)
    assert bad.count() == 1 and bad.first()["n_price"] == 4 and bad.first()["n_url"] == 5
    with pytest.raises(Q.FieldCountMismatch):
        Q.check_field_counts(blocks, strict=True)


def test_positional_compat_mode(spark, tmp_dir):
    blocks = R.read_report_blocks_wholetext(spark, write_report(tmp_dir), run_date="2024-11-09")
    rows = Q.positional_formatted(blocks).orderBy("rank").collect()
    # trimmed to the shortest list (4 prices): the reference's positional zip
    assert len(rows) == 4
    assert rows[0]["URL"].endswith("q1a2z.html") and rows[0]["Size_sq_m"] == "Platiba:>71.3 m²"
    assert rows[3]["Price"] == "Price:>61300 €"   # shifted by the missing price, as in the reference


def test_csv_readers(spark, tmp_dir):
    fmt = os.path.join(tmp_dir, "formatted.csv")
    with open(fmt, "w", encoding="utf-8") as f:
        f.write(",URL,Room_count,Size_sq_m,Floor,Street,Price,Pub_date\n")
        f.write("0,https://ss.lv/msg/lv/real-estate/flats/testa-nov/ezerpils/y6h7n.html,Istabas:>5,"
                "Platiba:>118 m²,Stavs:>6/8/lifts,Iela:><b>Egļu laukums 9,Price:>149 860 € (1 270 €/m²),Date:>14.06.2024\n")
    df = R.read_formatted_csv(spark, fmt)
    assert df.columns == ["URL", "Room_count", "Size_sq_m", "Floor", "Street", "Price", "Pub_date"]
    clean, q = E.clean_formatted(df.withColumn("source_file", F.lit(fmt)), run_date="2024-06-15")
    r = clean.first()
    assert (r["url_hash"], r["room_count"], r["price_eur"], r["street"]) == ("y6h7n", 5, 149860, "Egļu laukums 9")
    cleaned = os.path.join(tmp_dir, "cleaned.csv")
    with open(cleaned, "w", encoding="utf-8") as f:
        f.write(",URL,Room_count,Floor,Street,Pub_date,Size_sqm,Price_in_eur,SQ_meter_price\n")
        f.write("5,https://ss.lv/msg/lv/real-estate/flats/testa-nov/ezerpils/u8j9m.html,3,7/11,Osu ceļš 52,"
                "02.06.2024,84.5,99710,1180.00\n")
    c = E.cleaned_csv_to_clean_ads(R.read_cleaned_csv(spark, cleaned), "2024-06-15").first()
    assert (c["url_hash"], c["room_count"], c["apt_floor"], c["price_eur"], c["sqm_price_eur"]) == (
        "u8j9m", 3, 7, 99710, Decimal("1180.00"))


def test_empty_and_latest_file(spark, tmp_dir):
    from adlens import schemas
    assert R.empty_table(spark, schemas.CLEAN_ADS).count() == 0
    write_report(tmp_dir, RAW_REPORT, "r-2024-11-08.txt")
    os.utime(os.path.join(tmp_dir, "r-2024-11-08.txt"), (1_600_000_000, 1_600_000_000))
    write_report(tmp_dir, RAW_REPORT, "r-2024-11-09.txt")
    latest = R.latest_file(spark, tmp_dir).first()
    assert latest["path"].endswith("r-2024-11-09.txt")
    assert R.files_for_run_date(spark, tmp_dir, "2024-11-08").count() == 1


def test_bom_and_crlf(spark, tmp_dir):
    text = "\ufeff" + RAW_REPORT.replace("\n", "\r\n")
    path = os.path.join(tmp_dir, "r-2024-11-09.txt")
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    clean, quarantine = E.report_to_clean_ads(R.read_report_blocks(spark, tmp_dir))
    assert sorted(r["url_hash"] for r in clean.collect()) == ["e5d6c", "q1a2z", "t9g0b", "w3s4x"]
    assert [r["reason"] for r in quarantine.collect()] == ["missing:Price"]
