import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from adlens.functions import text as X


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr("v").alias("r")).first()["r"]


def test_strip_tokens(spark):
    df = spark.createDataFrame([("Istabas:>2", "Stavs:>3/9/lifts", "Iela:><b>Meža 4", "Date:>01.02.2022")],
                               "a string, b string, c string, d string")
    assert X.strip_tokens_all(df).first() == ("2", "3/9", "Meža 4", "01.02.2022")


def test_parse_size(spark):
    assert one(spark, X.parse_size, "50 m²") == Decimal("50.00")
    assert one(spark, X.parse_size, "40.90 m²") == Decimal("40.90")
    assert one(spark, X.parse_size, "abc m²") is None


def test_parse_price_edge_cases(spark):
    # SURVEY Q5: correct parse of multi-group, short and bracket-less prices
    assert one(spark, X.parse_price_total, "1 200 000 € (1 000 €/m²)") == 1200000
    assert one(spark, X.parse_price_total, "900 € (30 €/m²)") == 900
    assert one(spark, X.parse_price_total, "45000 €") == 45000
    assert one(spark, X.parse_price_per_sqm, "45000 €") is None
    assert one(spark, X.parse_price_total, "149 860 € (1 270 €/m²)") == 149860
    assert one(spark, X.parse_price_per_sqm, "149 860 € (1 270 €/m²)") == Decimal("1270.00")
    assert one(spark, X.parse_price_per_sqm, "88 250 € (1 237.73 €/m²)") == Decimal("1237.73")
    assert one(spark, X.parse_price_total, "57 000 €") == 57000
    assert one(spark, X.parse_price_total, "cena pēc vienošanās") is None


def test_normalise_street_literal_and_expand(spark):
    lit = lambda s: one(spark, X.normalise_street, s)
    assert lit("  Meža pr.4 ") == "Meža prospekts4"
    assert lit("Meža pr. 4") == "Meža pr. 4"           # Q6: literal rule needs a word char after the dot
    assert lit("Rīgas IEL.3") == "Rīgas iela3"
    assert lit("Brīvības blv.1") == "Brīvības bulvāris1"
    assert lit("Ogres ŠOS.5") == "Ogres šoseja5"       # Unicode case and boundary
    exp = lambda s: one(spark, lambda c: X.normalise_street(c, "expand"), s)
    assert exp("Meža pr. 4") == "Meža prospekts 4"
    assert exp("Meža pr.4") == "Meža prospekts 4"
    assert one(spark, X.normalise_street, None) is None


def test_url_hash(spark):
    assert one(spark, X.url_hash, "https://ss.lv/msg/lv/real-estate/flats/testa-nov/ezerpils/hejdl.html") == "hejdl"
    assert one(spark, X.url_hash, "https://ss.lv/msg/lv/") is None
    assert one(spark, X.url_hash, "") is None


def test_floor_split_and_lift(spark):
    df = spark.createDataFrame([("3/9",), ("1.00/3",), ("3/9/lifts",), ("x/y",)], "f string")
    rows = df.select(X.apt_floor("f"), X.house_floors("f"), X.has_lift("f")).collect()
    assert [tuple(r) for r in rows] == [(3, 9, False), (1, 3, False), (3, 9, True), (None, None, False)]


def test_dates(spark):
    assert one(spark, X.rotate_date, "01.07.2021") == "2021.07.01"
    assert one(spark, X.parse_stored_date, "2021.03.21") == dt.date(2021, 3, 21)
    assert one(spark, X.parse_source_date, "31.02.2021") is None
    assert one(spark, X.month_key, dt.date(2023, 12, 1), "v date") == "12.2023"


def test_days_listed_no_cap(spark):
    # Q9: plain datediff, no 0-for-one-day or 1000-day cap
    run = dt.date(2024, 1, 10)
    pubs = [run - dt.timedelta(days=n) for n in (0, 1, 999, 1000, -1)]
    df = spark.createDataFrame([(p,) for p in pubs], "p date")
    assert [r[0] for r in df.select(X.days_listed(run, "p")).collect()] == [0, 1, 999, 1000, -1]


def test_thousands(spark):
    df = spark.createDataFrame([(1200000, Decimal("1216.67"))], "a bigint, b decimal(10,2)")
    assert tuple(df.select(X.thousands("a"), X.thousands2("b")).first()) == ("1 200 000", "1 216.67")
