"""Adapters from the driver's tables to the ad domain.

The reference works on classified-ad reports; the test data are TPC-H-like
tables. These adapters define ads from those tables by plain column rules so
that every registered query reads the given tables and its work grows with
them. The same rules are written in SQL in ``plans/catalog.py`` for the
DuckDB oracle, which makes the text round trip (render -> parse) an
independent check.

part -> one ad per part:
  url_hash      'p' || p_partkey
  city          lower(p_type)  (URL: …/flats/riga-and-reg/<city>/<hash>.html)
  room_count    p_size % 5 + 1
  apt_floor     p_size % 9 + 1
  house_floors  apt_floor + p_partkey % 4, lift when house_floors >= 5
  size_sqm      (200 + 17 * p_size + p_partkey % 10) / 10
  price_eur     round(p_retailprice * 100) + 25000 * p_size
  sqm_price_eur price_eur / size_sqm, rounded half-up to cents
  street        p_name || ' iela ' || (p_partkey % 97 + 1)
  pub_date      2024-03-01 minus (p_partkey % 120) days
  series, type  p_brand, p_type
  ads of brand 'Brand#13' come without a price line (quarantine case)

events -> daily snapshots: the ads (users) seen on each day.
orders -> ads published on o_orderdate at price o_totalprice.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

AD_BASE_URL = "https://ss.lv/msg/lv/real-estate/flats/"
AD_REGION = "riga-and-reg"
PART_PUB_DATE_ANCHOR = _dt.date(2024, 3, 1)
NO_PRICE_BRAND = "Brand#13"


def _part_cols(part: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    size = F.col("p_size")
    apt = (size % 9 + 1).cast("int")
    house = (apt + (k % 4)).cast("int")
    size_dm = (F.lit(200) + size * 17 + k % 10).cast("bigint")
    price = (F.round(F.col("p_retailprice") * 100).cast("bigint") + size.cast("bigint") * 25000)
    h = F.concat(F.lit("p"), k.cast("string"))
    city = F.lower(F.col("p_type"))
    return part.select(
        k.alias("p_partkey"),
        F.concat(F.lit(AD_BASE_URL + AD_REGION + "/"), city, F.lit("/"), h, F.lit(".html")).alias("url"),
        h.alias("url_hash"), city.alias("city"),
        (size % 5 + 1).cast("int").alias("room_count"),
        apt.alias("apt_floor"), house.alias("house_floors"), (house >= 5).alias("has_lift"),
        F.concat(F.col("p_name"), F.lit(" iela "), (k % 97 + 1).cast("string")).alias("street"),
        F.date_sub(F.lit(PART_PUB_DATE_ANCHOR), (k % 120).cast("int")).alias("pub_date"),
        size_dm.alias("size_dm"), price.alias("price_eur"),
        F.col("p_brand").alias("series"), F.col("p_type").alias("house_type")
    # cents per m², rounded half-up, in integer arithmetic
    ).withColumn("sqm_cents", F.expr("(price_eur * 2000 + size_dm) div (size_dm * 2)"))


def ads_from_part(part: DataFrame, run_date=PART_PUB_DATE_ANCHOR) -> DataFrame:
    """Typed clean ads (CLEAN_ADS schema) straight from ``part``."""
    c = _part_cols(part)
    return c.where(F.col("series") != NO_PRICE_BRAND).select(
        "url", "url_hash", "city", F.col("room_count").cast("string").alias("room_label"),
        "room_count", "apt_floor", "house_floors", "has_lift", "street", "pub_date",
        (F.col("size_dm").cast("decimal(12,0)") / 10).cast("decimal(10,2)").alias("size_sqm"),
        "price_eur",
        (F.col("sqm_cents").cast("decimal(14,0)") / 100).cast("decimal(10,2)").alias("sqm_price_eur"),
        X.run_date_lit(run_date).alias("run_date"))


def _size_text() -> Column:
    return F.expr("format_string('%d.%d', size_dm div 10, size_dm % 10)")


def report_blocks_from_part(part: DataFrame) -> DataFrame:
    """Render one raw report block per part (the reference's text
    format), one STRING column ``block``."""
    c = _part_cols(part)
    floor = F.concat(F.col("apt_floor").cast("string"), F.lit("/"), F.col("house_floors").cast("string"),
                     F.when(F.col("has_lift"), F.lit("/lifts")).otherwise(F.lit("")))
    price_line = F.concat(F.lit("Price:>"), X.thousands("price_eur"), F.lit(" € ("),
                          X.thousands2(F.col("sqm_cents").cast("decimal(14,0)") / 100), F.lit(" €/m²)"))
    lines = [
        F.col("url"),
        F.lit("Pilsēta, rajons:><b>Rīga"),
        F.concat(F.lit("Iela:><b>"), F.col("street")),
        F.concat(F.lit("Istabas:>"), F.col("room_count").cast("string")),
        F.concat(F.lit("Platība:>"), _size_text(), F.lit(" m²")),
        F.concat(F.lit("Stāvs:>"), floor),
        F.concat(F.lit("Sērija:>"), F.col("series")),
        F.concat(F.lit("Mājas tips:>"), F.col("house_type")),
        F.when(F.col("series") != NO_PRICE_BRAND, price_line),
        F.concat(F.lit("Date:>"), X.format_source_date("pub_date")),
    ]
    return c.select(F.concat_ws("\n", *lines).alias("block"))


def snapshots_from_events(events: DataFrame) -> DataFrame:
    """events -> daily snapshots (ad_key, run_date): an ad is listed on every
    day it has an event. Distinct first, so a hot user costs one row per day."""
    return events.select(F.col("user_id").alias("ad_key"),
                         F.to_date("ts").alias("run_date")).distinct()


def ads_from_orders(orders: DataFrame) -> DataFrame:
    """orders -> ads: published on the order date at the order's price."""
    return orders.select(F.col("o_orderkey").alias("ad_key"),
                         F.to_date("o_orderdate").alias("pub_date"),
                         F.col("o_orderstatus").alias("segment"),
                         X.money("o_totalprice").alias("price"))


def _event_attrs(key: Column, day: Column) -> dict[str, Column]:
    """Attributes of an event ad on a day: plain rules on key and day; the
    price moves by 100 a day, and every fiftieth ad costs over 2^31."""
    dear = key % 50 == 0
    size_dm = F.when(dear, F.lit(1500)).otherwise(200 + key * 13 % 900).cast("bigint")
    price = (F.when(dear, F.lit(3_000_000_000)).otherwise(20_000 + key * 37 % 600_000) + F.dayofyear(day) * 100).cast("bigint")
    return {"room_count": (key % 5 + 1).cast("int"), "house_floors": (key % 9 + 2).cast("int"), "apt_floor": (key % 3 + 1).cast("int"),
            "price_eur": price, "size_dm": size_dm, "street": F.concat(F.lit("Iela "), (key % 50).cast("string"))}


def ads_from_snapshots(snapshots: DataFrame) -> DataFrame:
    """Daily snapshots -> clean ads: each (ad, day) is an ad seen on that
    day, published that day (so a new ad's list date is its first day)."""
    key = F.col("ad_key").cast("string")
    attrs = _event_attrs(F.col("ad_key"), F.col("run_date"))
    rows = snapshots.select("ad_key", "run_date", *[c.alias(n) for n, c in attrs.items()])
    cents = F.expr("(price_eur * 2000 + size_dm) div (2 * size_dm)").cast("decimal(20,0)")
    return rows.select(
        F.concat(F.lit(AD_BASE_URL + AD_REGION + "/events/"), key, F.lit(".html")).alias("url"),
        key.alias("url_hash"), F.lit("events").alias("city"), F.col("room_count").cast("string").alias("room_label"),
        "room_count", "apt_floor", "house_floors", F.lit(False).alias("has_lift"), "street", F.col("run_date").alias("pub_date"),
        (F.col("size_dm").cast("decimal(12,0)") / 10).cast("decimal(10,2)").alias("size_sqm"), "price_eur",
        (cents / 100).cast("decimal(10,2)").alias("sqm_price_eur"), "run_date")


def open_ads_as_listed(periods: DataFrame) -> DataFrame:
    """W4 listing periods that are still open -> LISTED_ADS rows, with the
    attributes of their first day (Q19)."""
    attrs = _event_attrs(F.col("ad_key"), F.col("list_date"))
    rows = periods.where(F.col("removed_date").isNull()).select("*", *[c.alias(n) for n, c in attrs.items()])
    cents = F.expr("(price_eur * 2000 + size_dm) div (2 * size_dm)")
    return rows.withColumn("_cents", cents).select(
        F.col("ad_key").cast("string").alias("url_hash"), "room_count", "house_floors", "apt_floor",
        F.col("price_eur").alias("price"), F.expr("(size_dm + 5) div 10").alias("sqm"),
        F.expr("(_cents + 50) div 100").alias("sqm_price"), F.col("street").alias("apt_address"), "list_date",
        F.col("days_listed").cast("int").alias("days_listed"), F.lit(None).cast("int").alias("view_count"))


def weekly_ads_from_events(events: DataFrame) -> DataFrame:
    """events -> weekly snapshots (ad_key, run_date): one ad per user and hour
    of the day, listed in every week in which it has an event."""
    return events.select((F.col("user_id").cast("bigint") * 24 + F.hour("ts")).alias("ad_key"),
                         F.to_date(F.date_trunc("week", "ts")).alias("run_date")).distinct()


def _cell_row(name: str, value: Column) -> Column:
    return F.concat(F.lit(f'<tr><td class="ads_opt_name">{name}</td><td class="ads_opt">'), value,
                    F.lit("</td></tr>"))


def ad_pages_from_part(part: DataFrame) -> DataFrame:
    """part -> one stored ad page per part in the ad-page structure the page
    extraction reads: option name/value cells in ``table#page_main``, a
    price cell (absent for the no-price brand) and footer cells with the
    publication date. Columns: page_id, url, html."""
    c = _part_cols(part)
    floor = F.concat(F.col("apt_floor").cast("string"), F.lit("/"), F.col("house_floors").cast("string"),
                     F.when(F.col("has_lift"), F.lit("/lifts")).otherwise(F.lit("")))
    price = F.concat(X.thousands("price_eur"), F.lit(" € ("),
                     X.thousands2(F.col("sqm_cents").cast("decimal(14,0)") / 100), F.lit(" €/m²)"))
    html = F.concat(
        F.lit('<html><body><table id="page_main">'),
        _cell_row("Iela:", F.concat(F.lit("<b>"), F.col("street"), F.lit("</b>"))),
        _cell_row("Istabas:", F.col("room_count").cast("string")),
        _cell_row("Platība:", F.concat(_size_text(), F.lit(" m²"))),
        _cell_row("Stāvs:", floor),
        _cell_row("Sērija:", F.col("series")),
        F.lit('<tr><td class="ads_opt_name">Karte:</td></tr>'),
        F.when(F.col("series") != NO_PRICE_BRAND,
               F.concat(F.lit('<tr><td class="ads_price">'), price, F.lit("</td></tr>"))).otherwise(F.lit("")),
        F.lit('<tr><td class="msg_footer">Reklāma</td><td class="msg_footer">Skatījumi</td>'
              '<td class="msg_footer">Datums: '), X.format_source_date("pub_date"),
        F.lit(" 10:00</td></tr></table></body></html>"))
    return c.select(F.col("p_partkey").alias("page_id"), "url", html.alias("html"))
