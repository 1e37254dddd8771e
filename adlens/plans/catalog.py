"""Registered queries over the driver's tables, each with its DuckDB oracle.

Every query reads the given tables (or data Spark derives from them) in
full; the adapters in ``plans/adapters.py`` map them to the ad domain. The
oracle SQL restates the same rules independently in SQL. Columns carry the
same names and types on both sides; averages are compared as exact decimals
(the SQL side rounds half-up in integer arithmetic).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import text as X
from ..operators import extract as E
from ..operators import lifecycle as L
from ..operators import ranking as RK
from ..operators import report as RP
from ..operators import stats as ST
from ..operators.sizing import spread
from ..session import scratch_path
from ..sources import reports as SR
from . import adapters as A
from . import adhoc as Z

# Run date used by queries that need one (a parameter, never current_date()).
PART_RUN_DATE = A.PART_PUB_DATE_ANCHOR           # 2024-03-01
ORDERS_RUN_DATE = _dt.date(2002, 1, 1)


def T(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- shared SQL fragments (oracle side) ---------------------------------------

PART_ADS_SQL = """
part_ads as (
  select p_partkey,
         'https://ss.lv/msg/lv/real-estate/flats/riga-and-reg/' || lower(p_type) || '/p' || cast(p_partkey as varchar) || '.html' as url,
         'p' || cast(p_partkey as varchar) as url_hash,
         lower(p_type) as city,
         cast(p_size % 5 + 1 as integer) as room_count,
         cast(p_size % 9 + 1 as integer) as apt_floor,
         cast(p_size % 9 + 1 + p_partkey % 4 as integer) as house_floors,
         (p_size % 9 + 1 + p_partkey % 4) >= 5 as has_lift,
         p_name || ' iela ' || cast(p_partkey % 97 + 1 as varchar) as street,
         cast(date '2024-03-01' - cast(p_partkey % 120 as integer) as date) as pub_date,
         cast((200 + 17 * p_size + p_partkey % 10) * 0.1 as decimal(10,2)) as size_sqm,
         cast(round(p_retailprice * 100) as bigint) + 25000 * cast(p_size as bigint) as price_eur,
         cast(((cast(round(p_retailprice * 100) as bigint) + 25000 * cast(p_size as bigint)) * 2000
               + (200 + 17 * p_size + p_partkey % 10)) // (2 * (200 + 17 * p_size + p_partkey % 10)) * 0.01
              as decimal(10,2)) as sqm_price_eur,
         p_brand, p_type
  from part)"""

PRICED_PART_ADS_SQL = PART_ADS_SQL + """,
ads as (select * from part_ads where p_brand <> 'Brand#13')"""


def _avg_sql(x: str, cnt: str | None = None) -> str:
    """Exact half-up average to 2 decimals of a 2-decimal money column."""
    cents = f"cast(round({x} * 100) as hugeint)"
    c = cnt or f"count({x})"
    return f"cast((2 * sum({cents}) + {c}) // (2 * {c}) * 0.01 as decimal(18,2))"


def _money_sql(x: str) -> str:
    return f"cast(round({x}, 2) as decimal(18,2))"


EVENTS_DAYS_SQL = """
s as (select distinct user_id as k, cast(ts as date) as d from events),
c as (select d, row_number() over (order by d) as i, lead(d) over (order by d) as nxt
      from (select distinct d from s))"""

ISLANDS_SQL = EVENTS_DAYS_SQL + """,
g as (select s.k, s.d, c.i - row_number() over (partition by s.k order by s.d) as grp from s join c on s.d = c.d),
isl as (select k, min(d) as list_date, max(d) as last_d from g group by k, grp),
life as (select isl.k as ad_key, isl.list_date, c.nxt as removed_date,
                cast(date_diff('day', isl.list_date, isl.last_d) as integer) as days_listed
         from isl join c on isl.last_d = c.d)"""

def event_price_sql(k: str, d: str) -> str:
    return (f"cast(case when {k} % 50 = 0 then 3000000000 else 20000 + {k} * 37 % 600000 end"
            f" + date_part('dayofyear', {d}) * 100 as bigint)")


def event_attrs_sql(k: str, d: str) -> str:
    """The open-ads attributes of an event ad first seen on day ``d``."""
    size = f"cast(case when {k} % 50 = 0 then 1500 else 200 + {k} * 13 % 900 end as bigint)"
    price = event_price_sql(k, d)
    return (f"cast({k} % 5 + 1 as integer) as room_count, cast({k} % 9 + 2 as integer) as house_floors, "
            f"cast({k} % 3 + 1 as integer) as apt_floor, {price} as price, ({size} + 5) // 10 as sqm, "
            f"(({price} * 2000 + {size}) // (2 * {size}) + 50) // 100 as sqm_price, "
            f"'Iela ' || cast({k} % 50 as varchar) as apt_address")


STATUS_SQL = EVENTS_DAYS_SQL + """,
si as (select s.k, s.d, c.i, c.nxt from s join c on s.d = c.d),
status as (
  select a.k as ad_key, a.d as run_date,
         case when b.k is null then 'new' else 'still_listed' end as status
  from si a left join si b on a.k = b.k and b.i = a.i - 1
  union all
  select a.k, a.nxt, 'removed'
  from si a left join si b on a.k = b.k and b.i = a.i + 1
  where a.nxt is not null and b.k is null)"""


# --- Spark queries ----------------------------------------------------------------

def _part_report_blocks(spark, sf_dir):
    """The raw report rendered from ``part``, written as text in the
    shared folder, read back block by block (S1)."""
    part = spread(T(spark, sf_dir, "part"))
    path = scratch_path(spark, "report")
    A.report_blocks_from_part(part).write.mode("overwrite").text(path)
    return SR.read_report_blocks(spark, path, run_date=PART_RUN_DATE)


def _parse_once(tagged):
    """Parse once: pin the tagged table, then split clean / quarantine (the
    split filters then read the pinned table instead of re-running the
    parse through filter pushdown)."""
    from ..operators.sizing import pin
    return E.split_tagged(pin(tagged))


def _part_report_ads(spark, sf_dir):
    """K12 -> S1 -> H10 -> F2-F10 (clean ads, quarantine)."""
    return _parse_once(E.report_to_tagged_ads(_part_report_blocks(spark, sf_dir)))


def q_parse_raw_report(spark, sf_dir):
    clean, _ = _part_report_ads(spark, sf_dir)
    return clean.select("url_hash", "city", "room_count", "apt_floor", "house_floors", "has_lift", "street",
                        "pub_date", "size_sqm", "price_eur", "sqm_price_eur")


def q_quarantine(spark, sf_dir):
    _, quarantine = _part_report_ads(spark, sf_dir)
    return quarantine.select(X.url_hash(H.block_url("block")).alias("url_hash"), "reason")


def q_extra_fields(spark, sf_dir):
    """Carry the optional labels (series, house type) through the MAP."""
    parsed = SR.parse_blocks(_part_report_blocks(spark, sf_dir))
    return parsed.select(X.url_hash("url").alias("url_hash"),
                         H.field("fields", "Sērija").alias("series"),
                         H.field("fields", "Mājas tips").alias("house_type"),
                         F.size("fields").alias("n_fields"))


def _price_texts(spark, sf_dir):
    blocks = _part_report_blocks(spark, sf_dir)
    return blocks.select(X.url_hash(H.block_url("block")).alias("url_hash"),
                         H.label_value("block", H.LABEL_PRICE).alias("price_text"),
                         H.label_value("block", H.LABEL_SIZE).alias("size_text"))


def q_parse_price(spark, sf_dir):
    t = _price_texts(spark, sf_dir).where(F.col("price_text").isNotNull())
    return t.select("url_hash", X.parse_price_total("price_text").alias("price_eur"),
                    X.parse_price_per_sqm("price_text").alias("sqm_price_eur"))


def q_parse_size(spark, sf_dir):
    t = _price_texts(spark, sf_dir)
    return t.select("url_hash", X.parse_size("size_text").alias("size_sqm"))


def _ads(spark, sf_dir):
    return A.ads_from_part(T(spark, sf_dir, "part"), PART_RUN_DATE)


def _pages(spark, sf_dir):
    return spread(T(spark, sf_dir, "pages"))


def q_extract_links(spark, sf_dir):
    return E.page_links(_pages(spark, sf_dir), pattern="/")


def q_count_links(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    return pages.select("page_id", F.size(H.links("html")).alias("n_links"),
                        F.size(H.msg_links("html", pattern="/")).alias("n_distinct_links"))


def q_distinct_links(spark, sf_dir):
    return E.distinct_links(_pages(spark, sf_dir), pattern="/")


def q_extract_cells(spark, sf_dir):
    return E.page_cells(_pages(spark, sf_dir), "div", "ad")


def q_snapshot_diff(spark, sf_dir):
    return L.daily_status(A.snapshots_from_events(T(spark, sf_dir, "events")))


def q_run_metrics(spark, sf_dir):
    return L.run_metrics_from_status(L.daily_status(A.snapshots_from_events(T(spark, sf_dir, "events"))))


def _life(spark, sf_dir):
    return L.lifecycle_backfill(A.snapshots_from_events(T(spark, sf_dir, "events")))


def q_lifecycle_final(spark, sf_dir):
    return _life(spark, sf_dir).where(F.col("removed_date").isNull()).select("ad_key", "list_date", "days_listed")


def q_removed_history(spark, sf_dir):
    return _life(spark, sf_dir).where(F.col("removed_date").isNotNull()) \
        .select("ad_key", F.col("list_date").alias("listed_date"), "removed_date", "days_listed")


def _tables_with_prices(spark, sf_dir):
    """(open ads, removed ads) of the event ads with prices (Q19)."""
    life = _life(spark, sf_dir)
    attrs = A._event_attrs(F.col("ad_key"), F.col("list_date"))
    priced = life.select("*", attrs["price_eur"].alias("price"))
    return priced.where(F.col("removed_date").isNull()), priced.where(F.col("removed_date").isNotNull())


def q_table_counts(spark, sf_dir):
    """Open ads, removed ads, and the removed ones under the cap."""
    return ST.table_counts(*_tables_with_prices(spark, sf_dir))


def q_price_stats(spark, sf_dir):
    li = T(spark, sf_dir, "lineitem").select("l_returnflag", X.money("l_extendedprice").alias("price"))
    return ST.price_stats(li, "l_returnflag", "price")


def q_price_stats_total(spark, sf_dir):
    part = T(spark, sf_dir, "part").select("p_type", X.money("p_retailprice").alias("price"))
    return ST.price_stats(part, "p_type", "price", with_total=True)


def q_room_price_stats(spark, sf_dir):
    return ST.price_stats(_ads(spark, sf_dir), "room_count", "price_eur", with_total=True)


def q_price_stat_table(spark, sf_dir):
    return ST.price_stat_table(ST.price_stats(_ads(spark, sf_dir), "room_count", "price_eur", with_total=True),
                               "room_count")


def _orders_ads(spark, sf_dir):
    return A.ads_from_orders(T(spark, sf_dir, "orders"))


def q_pub_date_counts(spark, sf_dir):
    return ST.pub_date_counts(_orders_ads(spark, sf_dir))


def q_month_counts(spark, sf_dir):
    return ST.month_counts(_orders_ads(spark, sf_dir))


def q_days_listed(spark, sf_dir):
    o = _orders_ads(spark, sf_dir)
    src = X.format_source_date("pub_date")
    return o.select("ad_key", X.rotate_date(src).alias("list_date_text"),
                    X.days_listed(ORDERS_RUN_DATE, "pub_date").alias("days_listed"),
                    X.days_listed(ORDERS_RUN_DATE, X.parse_stored_date(X.rotate_date(src))).alias("days_listed_refresh"))


def q_value_counts_top_size(spark, sf_dir):
    return ST.value_counts(T(spark, sf_dir, "part"), "p_size", top=8)


def q_value_counts_top_qty(spark, sf_dir):
    return ST.value_counts(T(spark, sf_dir, "lineitem"), "l_quantity", top=8)


def q_value_counts_rooms(spark, sf_dir):
    return ST.value_counts(_ads(spark, sf_dir), "room_count")


def q_house_floor_dist(spark, sf_dir):
    return ST.value_counts(_ads(spark, sf_dir), "house_floors")


def q_avg_by_month_segment(spark, sf_dir):
    o = _orders_ads(spark, sf_dir)
    return ST.avg_by(o, [X.month_start("pub_date").alias("month_start"), "segment"], "price")


def q_avg_year_status(spark, sf_dir):
    """P9+P10: a year prefix as a pushable date range, and a status."""
    o = _orders_ads(spark, sf_dir)
    f = o.where((F.col("pub_date") >= F.lit(_dt.date(1996, 1, 1))) & (F.col("pub_date") < F.lit(_dt.date(1997, 1, 1)))
                & (F.col("segment") == "F"))
    return ST.avg_by(f, [X.month_start("pub_date").alias("month_start")], "price")


def q_paginate(spark, sf_dir):
    p = RK.paginate(_ads(spark, sf_dir), ["room_count"], ["price_eur", "url_hash"], page_size=8)
    return p.select("room_count", "url_hash", "price_eur", "rank_in_segment", "page_no")


def q_normalise_street(spark, sf_dir):
    part = T(spark, sf_dir, "part")
    abbr = F.element_at(F.array(*[F.lit(a) for a in ["pr.", "IEL.", "Blv.", "pr. ", "iel. "]]),
                        (F.col("p_partkey") % 5 + 1).cast("int"))
    raw = F.concat(F.lit(" "), F.col("p_name"), F.lit(" "), abbr, (F.col("p_partkey") % 10).cast("string"), F.lit(" "))
    return part.select(F.col("p_partkey"), raw.alias("street_raw")).select(
        "p_partkey", X.normalise_street("street_raw").alias("street"),
        X.normalise_street("street_raw", mode="expand").alias("street_expanded"))


def q_dedup_last(spark, sf_dir):
    ev = T(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    return L.last_per_key(ev, "user_id", ["ts", "event_id"])


def q_price_cap(spark, sf_dir):
    """The raw-column bound is a pushable superset of the exact test on
    the rounded price (round(x, 2) < cap implies x < cap)."""
    o = T(spark, sf_dir, "orders").where(F.col("o_totalprice") < L.PRICE_CAP)
    return A.ads_from_orders(o).where(F.col("price") < L.PRICE_CAP).select("ad_key", "price")


def q_scatter_bins(spark, sf_dir):
    return ST.scatter_bins(_ads(spark, sf_dir), "room_count", "size_sqm", "price_eur")


def q_report_lines(spark, sf_dir):
    return RP.ads_by_segment(_ads(spark, sf_dir), PART_RUN_DATE)


def q_pub_date_report(spark, sf_dir):
    return RP.pub_date_report(_orders_ads(spark, sf_dir))


def q_run_history_report(spark, sf_dir):
    return RP.run_history(q_run_metrics(spark, sf_dir))


def q_ads_table(spark, sf_dir):
    return RP.ads_table(_ads(spark, sf_dir))


def q_room_values(spark, sf_dir):
    return ST.digit_room_values(_ads(spark, sf_dir))


def q_segment_filter(spark, sf_dir):
    """The fixed room segments 1-4, and one equality filter."""
    ads = _ads(spark, sf_dir)
    return ads.where(F.col("room_count").between(1, 4) & (F.col("city") == "small")) \
        .select("url_hash", "room_count", "price_eur")


def q_new_flag(spark, sf_dir):
    ads = _ads(spark, sf_dir)
    return ads.groupBy("room_count").agg(
        F.count_if(F.col("pub_date") == X.run_date_lit(PART_RUN_DATE)).alias("new_ads"),
        F.count(F.lit(1)).alias("ads"))


def q_size_stats(spark, sf_dir):
    return ST.size_stats(_ads(spark, sf_dir))


def q_floor_filter(spark, sf_dir):
    return ST.floor_filter(_ads(spark, sf_dir)).select("url_hash", "apt_floor", "house_floors")


def q_street_stats(spark, sf_dir):
    return ST.street_stats(_ads(spark, sf_dir))


def q_room_share(spark, sf_dir):
    return ST.share_of_total(_ads(spark, sf_dir), "room_count")


def q_last_days(spark, sf_dir):
    return ST.last_days(_ads(spark, sf_dir), "pub_date", PART_RUN_DATE, 30).select("url_hash", "pub_date")


def q_city_counts(spark, sf_dir):
    ads = _ads(spark, sf_dir)
    return ads.groupBy(X.url_path_part("url", E.CITY_SEGMENT).alias("city")).agg(F.count(F.lit(1)).alias("ads"))


def q_adhoc_sql(spark, sf_dir):
    life = _life(spark, sf_dir)
    removed = life.where(F.col("removed_date").isNotNull()) \
        .select("ad_key", F.col("list_date").alias("listed_date"), "removed_date", "days_listed")
    return Z.run_sql(spark, ADHOC_QUERY, {"removed_ads": removed})


ADHOC_QUERY = ("SELECT days_listed, COUNT(days_listed) AS cnt FROM removed_ads "
               "GROUP BY days_listed ORDER BY COUNT(days_listed) DESC, days_listed")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parse_raw_report": q_parse_raw_report,
    "quarantine": q_quarantine,
    "extra_fields": q_extra_fields,
    "parse_price": q_parse_price,
    "parse_size": q_parse_size,
    "extract_links": q_extract_links,
    "count_links": q_count_links,
    "distinct_links": q_distinct_links,
    "extract_cells": q_extract_cells,
    "snapshot_diff": q_snapshot_diff,
    "run_metrics": q_run_metrics,
    "lifecycle_final": q_lifecycle_final,
    "removed_history": q_removed_history,
    "table_counts": q_table_counts,
    "price_stats": q_price_stats,
    "price_stats_total": q_price_stats_total,
    "room_price_stats": q_room_price_stats,
    "price_stat_table": q_price_stat_table,
    "pub_date_counts": q_pub_date_counts,
    "month_counts": q_month_counts,
    "days_listed": q_days_listed,
    "value_counts_top_size": q_value_counts_top_size,
    "value_counts_top_qty": q_value_counts_top_qty,
    "value_counts_rooms": q_value_counts_rooms,
    "house_floor_dist": q_house_floor_dist,
    "avg_by_month_segment": q_avg_by_month_segment,
    "avg_year_status": q_avg_year_status,
    "paginate": q_paginate,
    "normalise_street": q_normalise_street,
    "dedup_last": q_dedup_last,
    "price_cap": q_price_cap,
    "scatter_bins": q_scatter_bins,
    "report_lines": q_report_lines,
    "pub_date_report": q_pub_date_report,
    "run_history_report": q_run_history_report,
    "ads_table": q_ads_table,
    "room_values": q_room_values,
    "segment_filter": q_segment_filter,
    "new_flag": q_new_flag,
    "size_stats": q_size_stats,
    "floor_filter": q_floor_filter,
    "street_stats": q_street_stats,
    "room_share": q_room_share,
    "last_days": q_last_days,
    "city_counts": q_city_counts,
    "adhoc_sql": q_adhoc_sql,
}


# --- oracle SQL -----------------------------------------------------------------

def _w(*ctes: str) -> str:
    return "with " + ",".join(ctes)


ORACLE: dict[str, str] = {
    "parse_raw_report": _w(PRICED_PART_ADS_SQL) + """
select url_hash, city, room_count, apt_floor, house_floors, has_lift, street, pub_date, size_sqm, price_eur, sqm_price_eur
from ads""",
    "quarantine": "select 'p' || cast(p_partkey as varchar) as url_hash, 'missing:Price' as reason from part where p_brand = 'Brand#13'",
    "extra_fields": "select 'p' || cast(p_partkey as varchar) as url_hash, p_brand as series, p_type as house_type, "
                    "cast(case when p_brand = 'Brand#13' then 8 else 9 end as integer) as n_fields from part",
    "parse_price": _w(PRICED_PART_ADS_SQL) + " select url_hash, price_eur, sqm_price_eur from ads",
    "parse_size": _w(PART_ADS_SQL) + " select url_hash, size_sqm from part_ads",
    "extract_links": """
with l as (select page_id, unnest(regexp_extract_all(html, '<a\\b[^>]*\\bhref="([^"]*)"', 1)) as href,
                  unnest(range(1, len(regexp_extract_all(html, '<a\\b[^>]*\\bhref="([^"]*)"', 1)) + 1)) as i from pages),
f as (select page_id, 'https://ss.lv' || href as url, min(i) as first_i from l
      where ('https://ss.lv' || href) like '%/%' group by page_id, 'https://ss.lv' || href)
select page_id, cast(row_number() over (partition by page_id order by first_i) as integer) as link_pos, url from f""",
    "count_links": """
select page_id, cast(len(regexp_extract_all(html, '<a\\b[^>]*\\bhref="([^"]*)"', 1)) as integer) as n_links,
       cast(len(list_distinct(regexp_extract_all(html, '<a\\b[^>]*\\bhref="([^"]*)"', 1))) as integer) as n_distinct_links
from pages""",
    "distinct_links": """
with l as (select distinct page_id, 'https://ss.lv' || unnest(regexp_extract_all(html, '<a\\b[^>]*\\bhref="([^"]*)"', 1)) as url from pages)
select url, count(*) as n_pages from l group by url""",
    "extract_cells": """
with c as (select page_id, regexp_extract_all(html, '(?s)<div\\b[^>]*\\bclass="(?:[^"]*\\s)?ad(?:\\s[^"]*)?"[^>]*>(.*?)</', 1) as cells from pages),
u as (select page_id, unnest(range(1, len(cells) + 1)) as i, unnest(cells) as x from c)
select page_id, cast(i as integer) as cell_pos, replace(replace(replace(x, chr(9), ''), chr(13), ''), chr(10), '') as text
from u""",
    "snapshot_diff": _w(STATUS_SQL) + " select ad_key, run_date, status from status",
    "run_metrics": _w(STATUS_SQL) + """,
per_day as (select run_date,
                   count(*) filter (where status <> 'removed') as scraped,
                   count(*) filter (where status <> 'new') as in_db,
                   count(*) filter (where status = 'still_listed') as unchanged,
                   count(*) filter (where status = 'new') as new_ads,
                   count(*) filter (where status = 'removed') as removed
            from status group by run_date)
select run_date, scraped, in_db, unchanged, new_ads, removed, scraped as active_total,
       cast(sum(removed) over (order by run_date rows between unbounded preceding and current row) as bigint) as removed_total
from per_day""",
    "lifecycle_final": _w(ISLANDS_SQL) + " select ad_key, list_date, days_listed from life where removed_date is null",
    "removed_history": _w(ISLANDS_SQL) + """
select ad_key, list_date as listed_date, removed_date, days_listed from life where removed_date is not null""",
    "table_counts": _w(ISLANDS_SQL) + f"""
select count(*) filter (where removed_date is null) as active_total,
       count(*) filter (where removed_date is not null) as removed_total,
       count(*) filter (where removed_date is not null and {event_price_sql('ad_key', 'list_date')} < 500000) as removed_under_cap
from life""",
    "price_stats": f"""
select l_returnflag, count(*) as ad_count, min({_money_sql('l_extendedprice')}) as min_price,
       max({_money_sql('l_extendedprice')}) as max_price,
       cast(max({_money_sql('l_extendedprice')}) - min({_money_sql('l_extendedprice')}) as decimal(18,2)) as price_range,
       {_avg_sql('l_extendedprice')} as avg_price
from lineitem group by l_returnflag""",
    "price_stats_total": f"""
select p_type, count(*) as ad_count, min({_money_sql('p_retailprice')}) as min_price,
       max({_money_sql('p_retailprice')}) as max_price,
       cast(max({_money_sql('p_retailprice')}) - min({_money_sql('p_retailprice')}) as decimal(18,2)) as price_range,
       {_avg_sql('p_retailprice')} as avg_price, grouping(p_type) = 1 as is_total
from part group by rollup (p_type)""",
    "room_price_stats": _w(PRICED_PART_ADS_SQL) + f"""
select room_count, count(*) as ad_count, cast(min(price_eur) as decimal(18,2)) as min_price,
       cast(max(price_eur) as decimal(18,2)) as max_price,
       cast(max(price_eur) - min(price_eur) as decimal(18,2)) as price_range,
       {_avg_sql('price_eur')} as avg_price, grouping(room_count) = 1 as is_total
from ads group by rollup (room_count)""",
    "price_stat_table": _w(PRICED_PART_ADS_SQL) + f"""
select case when grouping(room_count) = 1 then 'all' else cast(room_count as varchar) end as "Room Segment",
       count(*) as "Ad count", cast(min(price_eur) as decimal(18,2)) as "Min Price",
       cast(max(price_eur) as decimal(18,2)) as "Max Price",
       cast(max(price_eur) - min(price_eur) as decimal(18,2)) as "Price Range",
       {_avg_sql('price_eur')} as "Avg Price"
from ads group by rollup (room_count)""",
    "pub_date_counts": """
select cast(o_orderdate as date) as pub_date, strftime(cast(o_orderdate as date), '%m.%Y') as month_key, count(*) as ad_count
from orders group by 1""",
    "month_counts": """
select cast(date_trunc('month', o_orderdate) as date) as month_start,
       strftime(cast(date_trunc('month', o_orderdate) as date), '%m.%Y') as month_key,
       count(distinct cast(o_orderdate as date)) as n_dates, count(*) as ad_count
from orders group by 1""",
    "days_listed": """
select o_orderkey as ad_key, strftime(cast(o_orderdate as date), '%Y.%m.%d') as list_date_text,
       cast(date_diff('day', cast(o_orderdate as date), date '2002-01-01') as integer) as days_listed,
       cast(date_diff('day', cast(o_orderdate as date), date '2002-01-01') as integer) as days_listed_refresh
from orders""",
    "value_counts_top_size": "select p_size, count(p_size) as cnt from part group by p_size order by cnt desc, p_size limit 8",
    "value_counts_top_qty": "select l_quantity, count(l_quantity) as cnt from lineitem group by l_quantity order by cnt desc, l_quantity limit 8",
    "value_counts_rooms": _w(PRICED_PART_ADS_SQL) + " select room_count, count(room_count) as cnt from ads group by room_count",
    "house_floor_dist": _w(PRICED_PART_ADS_SQL) + " select house_floors, count(house_floors) as cnt from ads group by house_floors",
    "avg_by_month_segment": f"""
select cast(date_trunc('month', o_orderdate) as date) as month_start, o_orderstatus as segment, count(*) as n,
       {_avg_sql('o_totalprice')} as avg_price
from orders group by 1, 2""",
    "avg_year_status": f"""
select cast(date_trunc('month', o_orderdate) as date) as month_start, count(*) as n, {_avg_sql('o_totalprice')} as avg_price
from orders where o_orderdate >= date '1996-01-01' and o_orderdate < date '1997-01-01' and o_orderstatus = 'F'
group by 1""",
    "paginate": _w(PRICED_PART_ADS_SQL) + """,
r as (select room_count, url_hash, price_eur,
             row_number() over (partition by room_count order by price_eur, url_hash) as rank_in_segment from ads)
select room_count, url_hash, price_eur, rank_in_segment, (rank_in_segment - 1) // 8 as page_no from r""",
    "normalise_street": """
with s as (select p_partkey, trim(' ' || p_name || ' ' || ['pr.', 'IEL.', 'Blv.', 'pr. ', 'iel. '][p_partkey % 5 + 1]
                  || cast(p_partkey % 10 as varchar) || ' ') as t from part)
select p_partkey,
  regexp_replace(regexp_replace(regexp_replace(t, '\\bpr\\.\\b', 'prospekts', 'gi'), '\\biel\\.\\b', 'iela', 'gi'),
                 '\\bblv\\.\\b', 'bulvāris', 'gi') as street,
  trim(regexp_replace(regexp_replace(regexp_replace(t, '\\bpr\\.\\s*', 'prospekts ', 'gi'), '\\biel\\.\\s*', 'iela ', 'gi'),
                 '\\bblv\\.\\s*', 'bulvāris ', 'gi')) as street_expanded
from s""",
    "dedup_last": """
select user_id, ts, event_id, event_type from (
  select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) where rn = 1""",
    "price_cap": f"select o_orderkey as ad_key, {_money_sql('o_totalprice')} as price from orders where {_money_sql('o_totalprice')} < 500000",
    "scatter_bins": _w(PRICED_PART_ADS_SQL) + """
select room_count, cast(floor(size_sqm / 10) * 10 as bigint) as size_bin,
       cast(floor(price_eur / 100000) * 100000 as bigint) as price_bin, count(*) as n
from ads group by 1, 2, 3""",
    "report_lines": _w(PRICED_PART_ADS_SQL) + """,
r as (select *, row_number() over (partition by room_count order by price_eur, url_hash) as rn from ads)
select 1 as section, room_count as segment, rn as line_no, 'ad' as line_kind,
       '  ' || room_count || '     ' || apt_floor || '/' || house_floors || '    ' || cast(size_sqm as varchar) || '   '
       || price_eur || ' EUR    ' || cast(sqm_price_eur as varchar) || ' EUR   ' || street || '   '
       || strftime(pub_date, '%d.%m.%Y') || ' ' || url || case when pub_date = date '2024-03-01' then ' [NEW]' else '' end as line
from r
union all select distinct 1, room_count, -1, 'segment_title', cast(room_count as varchar) || ' room apartment segment:' from ads
union all select distinct 1, room_count, 0, 'column_line',
  '[Rooms, Floor, Size, Price EUR, SQM Price EUR, Apartment Street, Pub_date,  URL]' from ads
union all select 0, null, 2, 'total', 'Total active listings: ' || count(*) from ads""",
    "pub_date_report": """
with d as (select cast(o_orderdate as date) as pub_date, count(*) as n from orders group by 1)
select cast(date_trunc('month', pub_date) as date) as month_start, pub_date,
       'Pub_date: ' || strftime(pub_date, '%d.%m.%Y') || ' ->  Listed add count: ' || n || ' ' as line from d
union all
select distinct cast(date_trunc('month', pub_date) as date), cast(null as date),
       '--- Month: ' || strftime(pub_date, '%m.%Y') || ' ---' from d""",
    "ads_table": _w(PRICED_PART_ADS_SQL) + """
select room_count as "Rooms", apt_floor || '/' || house_floors as "Floor", size_sqm as "Size", price_eur as "Price",
       sqm_price_eur as "SQM Price", street as "Apartment Street", strftime(pub_date, '%d.%m.%Y') as "Pub_date", url as "URL"
from ads""",
    "room_values": _w(PRICED_PART_ADS_SQL) + " select distinct room_count from ads",
    "segment_filter": _w(PRICED_PART_ADS_SQL) + """
select url_hash, room_count, price_eur from ads where room_count between 1 and 4 and city = 'small'""",
    "new_flag": _w(PRICED_PART_ADS_SQL) + """
select room_count, count(*) filter (where pub_date = date '2024-03-01') as new_ads, count(*) as ads from ads group by 1""",
    "size_stats": _w(PRICED_PART_ADS_SQL) + f"""
select room_count, count(*) as n, min(size_sqm) as min_size, max(size_sqm) as max_size,
       cast((2 * sum(cast(size_sqm * 100 as hugeint)) + count(*)) // (2 * count(*)) * 0.01 as decimal(10,2)) as avg_size
from ads group by 1""",
    "floor_filter": _w(PRICED_PART_ADS_SQL) + """
select url_hash, apt_floor, house_floors from ads where apt_floor > 1 and apt_floor < house_floors and house_floors <> 9""",
    "street_stats": _w(PRICED_PART_ADS_SQL) + f"""
select trim(regexp_replace(street, '(\\s+\\d[\\w/.-]*)+\\s*$', '')) as street_name, count(*) as n,
       {_avg_sql('price_eur')} as avg_price
from ads group by 1""",
    "room_share": _w(PRICED_PART_ADS_SQL) + """,
g as (select room_count, count(*) as cnt from ads group by 1)
select room_count, cnt, cast((cnt * 20000 + sum(cnt) over ()) // (2 * sum(cnt) over ()) * 0.01 as decimal(9,2)) as pct from g""",
    "last_days": _w(PRICED_PART_ADS_SQL) + """
select url_hash, pub_date from ads where pub_date > date '2024-03-01' - 30 and pub_date <= date '2024-03-01'""",
    "city_counts": _w(PRICED_PART_ADS_SQL) + " select split_part(url, '/', 9) as city, count(*) as ads from ads group by 1",
    "adhoc_sql": _w(ISLANDS_SQL) + """
select days_listed, count(days_listed) as cnt from life where removed_date is not null
group by days_listed order by count(days_listed) desc, days_listed""",
}

ORACLE["run_history_report"] = _w(STATUS_SQL) + """,
per_day as (select run_date,
                   count(*) filter (where status <> 'removed') as scraped,
                   count(*) filter (where status <> 'new') as in_db,
                   count(*) filter (where status = 'still_listed') as unchanged,
                   count(*) filter (where status = 'new') as new_ads,
                   count(*) filter (where status = 'removed') as removed
            from status group by run_date),
m as (select *, sum(removed) over (order by run_date rows between unbounded preceding and current row) as removed_total
      from per_day)
select run_date,
       strftime(run_date, '%d.%m.%Y') || ': Scraped today: ' || scraped || ' | In DB: ' || in_db || ' | Unchanged: '
       || unchanged || ' | New ads: ' || new_ads || ' | Removed: ' || removed as line,
       'Active listings in DB: ' || scraped || ' | Removed ads in DB: ' || removed_total as counts_line
from m"""




# --- sinks read back, logs, single lifecycle step, quality, combined report ---

def q_cleaned_csv_roundtrip(spark, sf_dir):
    """K1/K3 + S3: ads written in the reference's cleaned-CSV layout and read
    back with a fixed schema."""
    from ..sinks.writers import write_cleaned_csv
    path = scratch_path(spark, "cleaned-csv")
    write_cleaned_csv(spread(_ads(spark, sf_dir)), path)
    back = E.cleaned_csv_to_clean_ads(SR.read_cleaned_csv(spark, path), PART_RUN_DATE)
    return back.select("url_hash", "city", "room_count", "apt_floor", "house_floors", "street", "pub_date",
                       "size_sqm", "price_eur", "sqm_price_eur")


def q_dated_copy(spark, sf_dir):
    """K2 + S4/S11: a dated copy per publication date, read back for a date
    range; partition pruning reads only the matching folders."""
    from ..sinks.writers import write_dated
    path = scratch_path(spark, "dated")
    write_dated(_ads(spark, sf_dir).select("url_hash", "price_eur", "pub_date"), path, "pub_date")
    back = spark.read.schema("url_hash string, price_eur bigint, pub_date date").parquet(path)
    return back.where(F.col("pub_date") >= F.lit(_dt.date(2024, 2, 15)))


# fixed values: the worker log's line formats
LOG_RESULT_LINE = "{} 00:40:00 [INFO ]: snapshot_diff: Result {} new, {} still_listed, {} to_remove hashes"
LOG_NOISE_LINE = "{} 00:40:01 [INFO ]: table_counts: Active listings in DB: {}"


def q_log_tail(spark, sf_dir):
    """K4 + S10 + P12 + O6: the worker log (one result line and one other
    line per run, appended as text) read back, filtered case-insensitively
    for 'result', fields picked, last three runs by time."""
    from ..sinks.writers import append_lines
    metrics = q_run_metrics(spark, sf_dir)
    fmt = lambda t: F.format_string(t.replace("{}", "%s"), *args)
    args = [F.col("run_date").cast("string"), F.col("new_ads"), F.col("unchanged"), F.col("removed")]
    result = fmt(LOG_RESULT_LINE)
    args = [F.col("run_date").cast("string"), F.col("active_total")]
    noise = fmt(LOG_NOISE_LINE)
    path = scratch_path(spark, "worker-log")
    append_lines(metrics.select(F.explode(F.array(result, noise)).alias("line")), path)
    lines = SR.read_log_lines(spark, path).where(F.lower("line").contains("result"))
    ts = F.to_timestamp_ntz(F.regexp_extract("line", r"^(\S+ \S+)", 1), F.lit("yyyy-MM-dd HH:mm:ss"))
    picked = lines.select(ts.alias("logged_at"),
                          *[F.regexp_extract("line", r"(\d+) " + w, 1).cast("bigint").alias(n)
                            for w, n in (("new", "new_ads"), ("still_listed", "still_listed"), ("to_remove", "removed"))])
    return picked.orderBy(F.desc("logged_at")).limit(3)


def _last_snapshot_step(spark, sf_dir):
    """J2-J6 on real data: the state before the last snapshot day (from the
    W4 backfill of the earlier days) and the last day's ads, one J4 step."""
    snaps = A.snapshots_from_events(T(spark, sf_dir, "events"))
    last = snaps.agg(F.max("run_date").alias("d")).first()["d"]
    prev = A.open_ads_as_listed(L.lifecycle_backfill(snaps.where(F.col("run_date") < F.lit(last))))
    today = A.ads_from_snapshots(snaps.where(F.col("run_date") == F.lit(last)))
    return L.lifecycle_step(prev, today, last, persist=False)   # each query reads one output


def q_lifecycle_step(spark, sf_dir):
    step = _last_snapshot_step(spark, sf_dir)
    return step.listed_next.select(F.col("url_hash").cast("bigint").alias("ad_key"), *[c for c in L.LISTED_COLS if c not in ("url_hash", "view_count")])


def q_lifecycle_step_removed(spark, sf_dir):
    step = _last_snapshot_step(spark, sf_dir)
    return step.removed_delta.select(F.col("url_hash").cast("bigint").alias("ad_key"), "room_count", "house_floors", "apt_floor",
                                     "price", "sqm", "sqm_price", "apt_address", "listed_date", "removed_date", "days_listed")


def q_field_counts(spark, sf_dir):
    """V1 over the whole rendered report: how often each field occurs."""
    from ..operators.quality import field_counts
    per_file = field_counts(_part_report_blocks(spark, sf_dir))
    names = [c for c in per_file.columns if c.startswith("n_")]
    tot = per_file.agg(*[F.sum(c).cast("bigint").alias(c) for c in names])
    return tot.withColumn("balanced", F.least(*names) == F.greatest(*names))


def q_validate_snapshot(spark, sf_dir):
    """V7 on the lifecycle tables: both load, counts, duplicate open keys."""
    from ..operators.quality import validate_snapshot
    life = _life(spark, sf_dir)
    listed = life.where(F.col("removed_date").isNull()).withColumnRenamed("ad_key", "url_hash")
    removed = life.where(F.col("removed_date").isNotNull())
    return validate_snapshot(listed, removed)


def q_listed_by_month(spark, sf_dir):
    """Listing periods by month of the list date."""
    life = _life(spark, sf_dir)
    return life.groupBy(X.month_start("list_date").alias("month_start")).agg(
        F.count(F.lit(1)).alias("listed"), F.count("removed_date").alias("removed"),
        F.sum("days_listed").cast("bigint").alias("days_total"))


def q_combined_report(spark, sf_dir):
    """Ads by segment, the stat lines, the publication-date report and
    the run history in one ordered line table."""
    return RP.combined_report(_ads(spark, sf_dir), PART_RUN_DATE, metrics=q_run_metrics(spark, sf_dir))


QUERIES.update({
    "cleaned_csv_roundtrip": q_cleaned_csv_roundtrip,
    "dated_copy": q_dated_copy,
    "log_tail": q_log_tail,
    "lifecycle_step": q_lifecycle_step,
    "lifecycle_step_removed": q_lifecycle_step_removed,
    "field_counts": q_field_counts,
    "validate_snapshot": q_validate_snapshot,
    "listed_by_month": q_listed_by_month,
    "combined_report": q_combined_report,
})

RUN_METRICS_SQL = STATUS_SQL + """,
per_day as (select run_date,
                   count(*) filter (where status <> 'removed') as scraped,
                   count(*) filter (where status <> 'new') as in_db,
                   count(*) filter (where status = 'still_listed') as unchanged,
                   count(*) filter (where status = 'new') as new_ads,
                   count(*) filter (where status = 'removed') as removed
            from status group by run_date)"""

ORACLE.update({
    "cleaned_csv_roundtrip": _w(PRICED_PART_ADS_SQL) + """
select url_hash, city, room_count, apt_floor, house_floors, street, pub_date, size_sqm, price_eur, sqm_price_eur from ads""",
    "dated_copy": _w(PRICED_PART_ADS_SQL) + " select url_hash, price_eur, pub_date from ads where pub_date >= date '2024-02-15'",
    "log_tail": _w(RUN_METRICS_SQL) + """
select cast(run_date as timestamp) + interval 40 minute as logged_at, new_ads, unchanged as still_listed, removed
from per_day order by run_date desc limit 3""",
    "lifecycle_step": _w(ISLANDS_SQL) + f"""
select ad_key, {event_attrs_sql('ad_key', 'list_date')}, list_date, days_listed from life where removed_date is null""",
    "lifecycle_step_removed": _w(ISLANDS_SQL) + f"""
select ad_key, {event_attrs_sql('ad_key', 'list_date')}, list_date as listed_date, removed_date, days_listed from life
where removed_date = (select max(d) from c)""",
    "field_counts": """
select count(*) as n_url, count(*) as n_room_count, count(*) as n_size_sq_m, count(*) as n_floor, count(*) as n_street,
       count(*) filter (where p_brand <> 'Brand#13') as n_price, count(*) as n_pub_date,
       count(*) filter (where p_brand = 'Brand#13') = 0 as balanced
from part""",
    "validate_snapshot": _w(ISLANDS_SQL) + """
select count(*) filter (where removed_date is null) as listed_rows,
       count(distinct ad_key) filter (where removed_date is null) as listed_keys,
       count(*) filter (where removed_date is not null) as removed_rows,
       count(*) filter (where removed_date is null) - count(distinct ad_key) filter (where removed_date is null)
         as duplicate_open_keys
from life""",
    "listed_by_month": _w(ISLANDS_SQL) + """
select cast(date_trunc('month', list_date) as date) as month_start, count(*) as listed, count(removed_date) as removed,
       cast(sum(days_listed) as bigint) as days_total
from life group by 1""",
})

ORACLE["combined_report"] = _w(PRICED_PART_ADS_SQL, RUN_METRICS_SQL) + f""",
r as (select *, row_number() over (partition by room_count order by price_eur, url_hash) as rn from ads),
st as (select room_count, grouping(room_count) = 1 as is_total, count(*) as ad_count,
              cast(min(price_eur) as decimal(18,2)) as min_price, cast(max(price_eur) as decimal(18,2)) as max_price,
              cast(max(price_eur) - min(price_eur) as decimal(18,2)) as price_range, {_avg_sql('price_eur')} as avg_price
       from ads group by rollup (room_count)),
pd as (select pub_date, count(*) as n from ads group by 1),
m as (select *, sum(removed) over (order by run_date rows between unbounded preceding and current row) as removed_total
      from per_day)
select 1 as section, room_count as segment, rn as line_no, 'ad' as line_kind,
       '  ' || room_count || '     ' || apt_floor || '/' || house_floors || '    ' || cast(size_sqm as varchar) || '   '
       || price_eur || ' EUR    ' || cast(sqm_price_eur as varchar) || ' EUR   ' || street || '   '
       || strftime(pub_date, '%d.%m.%Y') || ' ' || url || case when pub_date = date '2024-03-01' then ' [NEW]' else '' end as line
from r
union all select distinct 1, room_count, -1, 'segment_title', cast(room_count as varchar) || ' room apartment segment:' from ads
union all select distinct 1, room_count, 0, 'column_line',
  '[Rooms, Floor, Size, Price EUR, SQM Price EUR, Apartment Street, Pub_date,  URL]' from ads
union all select 0, null, 2, 'total', 'Total active listings: ' || count(*) from ads
union all select 2, null, case when is_total then 2147483647 else room_count end, 'stat',
  case when is_total then 'all' else cast(room_count as varchar) end || ' | ' || ad_count || ' | ' || cast(min_price as varchar)
  || ' | ' || cast(max_price as varchar) || ' | ' || cast(price_range as varchar) || ' | ' || cast(avg_price as varchar) from st
union all select 3, null,
  date_diff('day', date '1970-01-01', cast(date_trunc('month', pub_date) as date)) * 100000
  + date_diff('day', cast(date_trunc('month', pub_date) as date), pub_date) + 1,
  'pub_date', 'Pub_date: ' || strftime(pub_date, '%d.%m.%Y') || ' ->  Listed add count: ' || n || ' ' from pd
union all select distinct 3, null,
  date_diff('day', date '1970-01-01', cast(date_trunc('month', pub_date) as date)) * 100000,
  'pub_date', '--- Month: ' || strftime(pub_date, '%m.%Y') || ' ---' from pd
union all select 4, null, date_diff('day', date '1970-01-01', run_date), 'run',
  strftime(run_date, '%d.%m.%Y') || ': Scraped today: ' || scraped || ' | In DB: ' || in_db || ' | Unchanged: '
  || unchanged || ' | New ads: ' || new_ads || ' | Removed: ' || removed from m"""


def _stored_ad_pages(spark, sf_dir):
    """Ad pages rendered from ``part`` and stored as a pages table in the
    shared folder (page_id, url, html), then scanned."""
    from ..operators.sizing import pin
    return pin(A.ad_pages_from_part(spread(T(spark, sf_dir, "part"))))


def q_parse_ad_pages(spark, sf_dir):
    """H4-H9: stored ad pages -> raw report text (written, as the reference
    writes its scraped report) -> S1 -> clean ads. The written report is the
    stage boundary: parsing filters are not pushed into page extraction."""
    blocks, _no_price = E.ad_pages_to_blocks(_stored_ad_pages(spark, sf_dir))
    path = scratch_path(spark, "page-report")
    blocks.select("block").write.mode("overwrite").text(path)
    clean, _ = _parse_once(E.report_to_tagged_ads(SR.read_report_blocks(spark, path, run_date=PART_RUN_DATE)))
    return clean.select("url_hash", "city", "room_count", "apt_floor", "house_floors", "has_lift", "street",
                        "pub_date", "size_sqm", "price_eur", "sqm_price_eur")


def q_ad_pages_quarantine(spark, sf_dir):
    _, no_price = E.ad_pages_to_blocks(_stored_ad_pages(spark, sf_dir))
    return no_price.select(X.url_hash("url").alias("url_hash"), "reason")


def q_formatted_csv_roundtrip(spark, sf_dir):
    """D3 -> K1 (formatted CSV with index column) -> S2 -> F1 -> typed."""
    parsed = SR.parse_blocks(_part_report_blocks(spark, sf_dir))
    formatted, _ = E.blocks_to_formatted(parsed)
    path = scratch_path(spark, "formatted-csv")
    (formatted.select(F.col("URL").alias("_idx"), *[n for n in ["URL"] + [f[0] for f in E.FORMATTED_FIELDS]])
     .write.mode("overwrite").option("header", True).csv(path))
    back = SR.read_formatted_csv(spark, path).withColumn("source_file", F.lit(path))
    clean, _ = _parse_once(E.formatted_to_tagged_ads(back, PART_RUN_DATE))
    return clean.select("url_hash", "city", "room_count", "apt_floor", "house_floors", "has_lift", "street",
                        "pub_date", "size_sqm", "price_eur", "sqm_price_eur")


QUERIES.update({
    "parse_ad_pages": q_parse_ad_pages,
    "ad_pages_quarantine": q_ad_pages_quarantine,
    "formatted_csv_roundtrip": q_formatted_csv_roundtrip,
})
ORACLE.update({
    "parse_ad_pages": ORACLE["parse_raw_report"],
    "ad_pages_quarantine": "select 'p' || cast(p_partkey as varchar) as url_hash, 'no_price' as reason from part where p_brand = 'Brand#13'",
    "formatted_csv_roundtrip": ORACLE["parse_raw_report"],
})


def _latest_pair(spark, sf_dir):
    """J1 as the daily run applies it: today's rows (one per event, so
    duplicates count) against the previous snapshot's distinct ads, for the
    latest two snapshot days."""
    ev = T(spark, sf_dir, "events").select(F.col("user_id").alias("ad_key"), F.to_date("ts").alias("run_date"))
    last_two = [r["run_date"] for r in ev.select("run_date").distinct().orderBy(F.desc("run_date")).limit(2).collect()]
    today = ev.where(F.col("run_date") == F.lit(last_two[0]))
    prev = ev.where(F.col("run_date") == F.lit(last_two[-1])).select("ad_key").distinct()
    return L.snapshot_diff(today, prev, key="ad_key")


def q_snapshot_diff_pair(spark, sf_dir):
    return _latest_pair(spark, sf_dir).select("ad_key", "status", F.col("n_today").cast("bigint").alias("n_today"))


def q_snapshot_diff_pair_metrics(spark, sf_dir):
    return L.diff_metrics(_latest_pair(spark, sf_dir))


QUERIES.update({
    "snapshot_diff_pair": q_snapshot_diff_pair,
    "snapshot_diff_pair_metrics": q_snapshot_diff_pair_metrics,
})

PAIR_SQL = """
d as (select distinct cast(ts as date) as d from events order by d desc limit 2),
t as (select user_id as ad_key, count(*) as n from events where cast(ts as date) = (select max(d) from d) group by 1),
p as (select distinct user_id as ad_key from events where cast(ts as date) = (select min(d) from d)),
j as (select coalesce(t.ad_key, p.ad_key) as ad_key,
             case when p.ad_key is null then 'new' when t.ad_key is null then 'removed' else 'still_listed' end as status,
             coalesce(t.n, 0) as n_today
      from t full outer join p on t.ad_key = p.ad_key)"""

ORACLE.update({
    "snapshot_diff_pair": _w(PAIR_SQL) + " select ad_key, status, cast(n_today as bigint) as n_today from j",
    "snapshot_diff_pair_metrics": _w(PAIR_SQL) + """
select cast(sum(n_today) as bigint) as scraped, count(*) filter (where status <> 'new') as in_db,
       cast(coalesce(sum(n_today) filter (where status = 'still_listed'), 0) as bigint) as unchanged,
       cast(coalesce(sum(n_today) filter (where status = 'new'), 0) as bigint) as new_ads,
       count(*) filter (where status = 'removed') as removed
from j""",
})


def q_segment_values(spark, sf_dir):
    """The distinct values of a segment column (cities)."""
    return ST.distinct_values(_ads(spark, sf_dir), "city")


def q_house_type_dist(spark, sf_dir):
    """Frequency of the house-type label parsed from the report text."""
    parsed = SR.parse_blocks(_part_report_blocks(spark, sf_dir))
    return ST.value_counts(parsed.select(H.field("fields", "Mājas tips").alias("house_type")), "house_type")


QUERIES.update({"segment_values": q_segment_values, "house_type_dist": q_house_type_dist})
ORACLE.update({
    "segment_values": _w(PRICED_PART_ADS_SQL) + " select distinct city from ads",
    "house_type_dist": "select p_type as house_type, count(p_type) as cnt from part group by p_type",
})


from . import history_queries as HQ  # noqa: E402 - uses the fragments above
from . import store_queries as SQ  # noqa: E402

QUERIES.update(SQ.QUERIES)
ORACLE.update(SQ.oracle(PRICED_PART_ADS_SQL, PART_ADS_SQL, ISLANDS_SQL, EVENTS_DAYS_SQL, event_attrs_sql, event_price_sql, _w))
QUERIES.update(HQ.QUERIES)
ORACLE.update(HQ.oracle(PRICED_PART_ADS_SQL, PART_ADS_SQL, ISLANDS_SQL, STATUS_SQL, event_attrs_sql, event_price_sql, _avg_sql, _money_sql, _w))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLE.items() if k in QUERIES}
