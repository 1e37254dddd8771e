"""Registered queries over the change log, keyed streams, digest trees, daily
states, positions and nested markup; their SQL is put together in ``oracle``.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import html as H
from ..functions import markup as M
from ..functions import text as X
from ..operators import asof, digest, quality, states
from ..operators import streets as streets_op
from ..operators import lifecycle as L
from ..operators import report as RP
from ..operators import stats as ST
from ..operators.sizing import pin, spread
from ..session import scratch_path, scratch_scope
from ..sinks.writers import write_table
from ..sources import positions as P
from ..sources import reports as SR
from ..streaming import keyed_listings as K
from . import adapters as A
from . import adhoc as Z
from . import delta_store as DS
from .store_queries import _as_tagged, _table, _weekly

ATTRS = ["room_count", "house_floors", "apt_floor", "price", "sqm", "sqm_price", "apt_address"]


def _key():
    return F.col("url_hash").cast("bigint").alias("ad_key")


def _delivered(spark, sf_dir) -> DS.DeltaStore:
    """Weekly event ads delivered to a change log in three parts: half of the
    second week comes late, with the last week; the log is compacted between."""
    rows = pin(_as_tagged(A.ads_from_snapshots(_weekly(spark, sf_dir))))
    weeks = sorted(r["run_date"] for r in rows.select("run_date").distinct().collect())
    late = ((F.col("run_date") == F.lit(weeks[min(1, len(weeks) - 1)])) & (F.col("url_hash").cast("bigint") % 2 == 1)) | (
        F.col("run_date") == F.lit(weeks[-1]))
    first = F.col("run_date") == F.lit(weeks[0])
    store = DS.DeltaStore(scratch_path(spark, "log"), compact_dates=0)
    DS.deliver(spark, store, rows.where(first & ~late), "first")
    DS.compact(spark, store)
    DS.deliver(spark, store, rows.where(~first & ~late), "second")
    DS.deliver(spark, store, rows.where(late), "third")
    return store


def q_delta_periods(spark, sf_dir):
    """Open ads and removal history of the change log are
    the listing periods."""
    with scratch_scope(spark):
        store = _delivered(spark, sf_dir)
        open_ = DS.read_open(spark, store).select(_key(), *ATTRS, "list_date", F.lit(None).cast("date").alias("removed_date"), "days_listed")
        gone = DS.read_removed(spark, store).select(_key(), *ATTRS, F.col("listed_date").alias("list_date"), "removed_date", "days_listed")
        return pin(open_.unionByName(gone), keep=True)


def q_delta_open_by_date(spark, sf_dir):
    """The open ads of every run date, read from the log (one
    read per run date: what a report of that date would do)."""
    with scratch_scope(spark):
        store = _delivered(spark, sf_dir)
        each = [DS.read_open(spark, store, d).select(F.lit(d).alias("run_date"), _key(), "price", "list_date", "days_listed")
                for d in DS.manifest(spark, store).dates()]
        return pin(reduce(DataFrame.unionByName, each), keep=True)


def q_delta_metrics(spark, sf_dir):
    """A12, K10, ST3: the metrics as the store wrote them. A part is
    delivered again, which is skipped and counts nothing twice."""
    with scratch_scope(spark):
        store = _delivered(spark, sf_dir)
        rows = DS.read_arrivals(spark, store)
        skipped = set(DS.deliver(spark, store, rows, "second").values()) == {"skipped"}
        out = DS.read_metrics(spark, store).select("run_date", "scraped", "in_db", "unchanged", "new_ads", "removed", "active_total", "removed_total",
                                                   F.lit(skipped).alias("rerun_skipped"))
        return pin(out, keep=True)


def q_stream_lifecycle(spark, sf_dir):
    """ST1-ST3, J4 as a stream: daily event ads arrive in three deliveries
    with days out of order, keyed state with a removal timer per ad makes the
    events; the stream is started anew from its checkpoint for each."""
    snapshots = A.snapshots_from_events(_table(spark, sf_dir, "events"))
    with scratch_scope(spark):
        ads = pin(A.ads_from_snapshots(snapshots))
        first = ads.agg(F.min("run_date").alias("d")).first()["d"]
        last = ads.agg(F.max("run_date").alias("d")).first()["d"]
        day = F.datediff("run_date", F.lit(first))
        late, third = day.isin(8, 18), F.floor(day / 10)
        inbox, out, ckpt = (scratch_path(spark, k) for k in ("inbox", "events", "stream"))
        # a day that comes two days late, in the next delivery; the last one ends with a mark far ahead
        when = F.when(late, third + 1).otherwise(F.when(day < 10, 0).when(day < 20, 1).otherwise(2))
        mark = ads.limit(1).withColumn("url_hash", F.lit("~end")).withColumn("run_date", F.lit(last + _dt.timedelta(days=30)))
        for i in range(3):
            rows = ads.where(when == i)
            (rows.unionByName(mark) if i == 2 else rows).write.mode("append").parquet(inbox)
            query = K.start(spark, spark.readStream.schema(ads.schema).parquet(inbox), out, ckpt, lateness="4 days")
            query.awaitTermination()
        events = spark.read.schema(K.EVENT).parquet(out).where("url_hash <> '~end'")
        return pin(K.listing_periods(events, ads).select(_key(), *ATTRS, "list_date", "removed_date", "days_listed"), keep=True)


def q_open_by_date(spark, sf_dir):
    """The ads open on every event date from the listing periods, by
    a join on months."""
    snapshots = pin(A.snapshots_from_events(_table(spark, sf_dir, "events")))
    found = asof.open_on(L.lifecycle_backfill(snapshots), snapshots)
    return found.select("run_date", "ad_key", "list_date", F.datediff("run_date", "list_date").alias("days_listed"))


def _digested(spark, snapshots) -> str:
    """The snapshots stored with their digest trees."""
    path, rows = scratch_path(spark, "digests"), pin(snapshots)
    largest = rows.groupBy("run_date").count().agg(F.max("count").alias("n")).first()["n"] or 0
    digest.write_snapshots(rows, path, digest.leaves_for(largest), "ad_key")
    return path


def q_digest_changes(spark, sf_dir):
    """J1 over all consecutive days by digest trees: new and removed ads."""
    with scratch_scope(spark):
        path = _digested(spark, A.snapshots_from_events(_table(spark, sf_dir, "events")))
        return pin(digest.diff(spark, path, "bigint").select(F.col("key").alias("ad_key"), "run_date", "status"), keep=True)


def q_digest_metrics(spark, sf_dir):
    """A12 from the digests and the changed ads alone."""
    with scratch_scope(spark):
        path = _digested(spark, _weekly(spark, sf_dir))
        return pin(digest.metrics(spark, path, digest.diff(spark, path, "bigint")), keep=True)


def q_merged_price_stats(spark, sf_dir):
    """A1/A10 over two years from daily states, written in two parts of which
    the second replaces a month of the first."""
    with scratch_scope(spark):
        ads = pin(A.ads_from_orders(_table(spark, sf_dir, "orders")))
        root = scratch_path(spark, "states")
        make = lambda rows: states.daily_states(rows, "pub_date", "segment", "price")
        states.write_states(make(ads.where("pub_date < date '1995-07-01'")), root)
        states.write_states(make(ads.where("pub_date >= date '1995-06-01'")), root)
        whole = states.merged(states.read_states(spark, root, _dt.date(1995, 2, 10), _dt.date(1997, 2, 9)))
        return pin(states.price_stats(whole), keep=True)


def q_size_ranges(spark, sf_dir):
    """Ranges of sizes per room segment."""
    return ST.size_ranges(A.ads_from_part(_table(spark, sf_dir, "part")))


_ADS_PER_FILE = 1000


def _positioned_report(spark, sf_dir) -> str:
    """Report files of a thousand ads each, in key order, every line indented
    by a blank; the file's name is its number."""
    path = scratch_path(spark, "report")
    key = F.regexp_extract("block", r"/p(\d+)\.html", 1).cast("bigint")
    blocks = A.report_blocks_from_part(_table(spark, sf_dir, "part")).withColumn("_k", key).select(
        F.regexp_replace("block", r"(?m)^", " ").alias("block"), "_k", F.expr(f"_k div {_ADS_PER_FILE}").alias("file"))
    (blocks.repartition("file").sortWithinPartitions("file", "_k").select("block", "file")
     .write.mode("overwrite").partitionBy("file").text(path))
    return path


def _file_number():
    return F.regexp_extract("source_file", r"file=(\d+)", 1).cast("bigint").alias("file")


def q_report_positions(spark, sf_dir):
    """Every block's place in its file, from files read in splits."""
    blocks = P.read_report_blocks_positions(spark, _positioned_report(spark, sf_dir), run_date=A.PART_PUB_DATE_ANCHOR)
    return blocks.select(_file_number(), "pos", X.url_hash(F.regexp_extract("block", r"(https\S+)", 1)).alias("url_hash"),
                         F.size(F.split("block", "\n")).alias("n_lines"))


def q_positional_zip(spark, sf_dir):
    """V2: the i-th address of a file with the i-th price and room count; ads
    without a price shift the prices of those after them."""
    lines = P.read_report_lines(spark, _positioned_report(spark, sf_dir), run_date=A.PART_PUB_DATE_ANCHOR)
    zipped = quality.positional_lines(lines)
    return zipped.select(_file_number(), "rank", X.url_hash(F.trim("URL")).alias("url_hash"),
                         X.parse_price_total(F.regexp_replace("Price", r"^\s*Price:>", "")).alias("price_eur"),
                         F.regexp_replace("Room_count", r"\D", "").cast("int").alias("room_count"))


def q_nested_markup(spark, sf_dir):
    """H1, H2, H4, H5, H7 where links and cells stand in comments and scripts
    too, spans hold spans, and characters are written as references."""
    k = F.col("p_partkey").cast("string")
    html = F.concat(
        F.lit("<!-- <a href='/msg/hidden'>x</a> <td class='ads_price'>0</td> --><script>var t = \"<a href='/msg/js'>\";</script>"),
        F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("<a title='a > b' href='/msg/"), k, F.lit("?x=1&amp;y=2'>l</a>")))
        .otherwise(F.concat(F.lit("<a href=/about>l</a><a href=\"/msg/"), k, F.lit("\">l</a>"))),
        F.lit("<table><tr><td class='ads_price'>outside</td></tr></table><table id='page_main'><tr><td class='x ads_price'>"),
        F.col("p_size").cast("string"), F.lit(" &#8364;</td></tr><tr><td><table><tr><td class=ads_price>"), k,
        F.lit("</td></tr></table></td></tr></table><td class='ads_price'>after</td>"),
        F.lit("<span class='n' id='note'>lot <span>no <b>"), k, F.lit("</b></span> of <!-- </span> -->&quot;LV&quot;<span/></span><span>end</span>"))
    pages = spread(_table(spark, sf_dir, "part")).select(F.col("p_partkey").alias("page_id"), M.tokens(html).alias("page"))
    pages = pages.select("page_id", "page", M.element("page", "table", "id", H.MAIN_TABLE_ID).alias("main"))
    return pages.select("page_id", F.array_join(M.msg_links("page"), " ").alias("links"),
                        F.array_join(M.cells("main", "td", H.CLASS_PRICE), "|").alias("prices"), M.span_text("page", "note").alias("note"))


def q_report_file_choice(spark, sf_dir):
    """Report files of three dates; the ads of those whose name holds
    a date, and of the folder with the newest file (the one written last)."""
    root = scratch_path(spark, "reports")
    key = F.regexp_extract("block", r"/p(\d+)\.html", 1).cast("bigint")
    blocks = pin(A.report_blocks_from_part(spread(_table(spark, sf_dir, "part"))).withColumn("_k", key))
    for i, day in ((0, "2024-02-28"), (2, "2024-03-01"), (1, "2024-02-29")):
        rows = blocks.where(F.col("_k") % 3 == i).select("block")
        rows.write.mode("append").text(f"{root}/report-{day}.txt")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(root).select(
        "path", "modificationTime", "length")
    named = [r["path"] for r in files.where(F.col("path").contains("2024-03-01")).select(F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("path")).distinct().collect()]
    newest = SR.latest_file(spark, f"{root}/*").select(F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("path")).first()["path"]
    read = lambda path, how: SR.read_report_blocks(spark, path).select(
        F.lit(how).alias("chosen_by"), X.url_hash(H.block_url("block")).alias("url_hash"), "run_date")
    return reduce(DataFrame.unionByName, [read(p, "name") for p in named]).unionByName(read(newest, "time"))


#: Every second name loses or changes a character, at a place by the key.
_MISSPELT = """
    CASE p_partkey % 4 WHEN 0 THEN concat(substr(s, 1, at - 1), substr(s, at + 1)) WHEN 1 THEN concat(substr(s, 1, at - 1), 'x', substr(s, at + 1)) ELSE s END"""


def q_street_spellings(spark, sf_dir):
    """The spellings of street names and the name each group goes by."""
    streets = _table(spark, sf_dir, "part").selectExpr("p_partkey", "concat(p_name, ' ', lower(p_type), ' iela') AS s").selectExpr(
        "p_partkey", "s", "CAST(p_partkey % length(s) AS INT) + 1 AS at").selectExpr(f"{_MISSPELT} AS street")
    with scratch_scope(spark):
        return pin(streets_op.canonical_names(streets, "street"), keep=True)


def q_adhoc_functions(spark, sf_dir):
    """An ad-hoc query that calls the text functions, with parameters."""
    blocks = A.report_blocks_from_part(spread(_table(spark, sf_dir, "part")))
    fields = blocks.select(H.block_url("block").alias("url"), *[H.label_value("block", label).alias(name) for name, label in (
        ("price", "Price"), ("size", "Platība"), ("floor", "Stāvs"), ("street", "Iela"), ("pub", "Date"))])
    return Z.run_sql(spark, """
        SELECT url_hash(url) AS url_hash, url_path_part(url, 8) AS city, parse_price(price) AS price_eur, parse_sqm_price(price) AS sqm_price_eur,
               parse_size(size) AS size_sqm, apt_floor(floor) AS apt_floor, house_floors(floor) AS house_floors, has_lift(floor) AS has_lift,
               normalise_street(strip_tokens(concat('Iela:>', street))) AS street, parse_source_date(pub) AS pub_date, rotate_date(pub) AS stored_date,
               days_listed(CAST(:run AS DATE), parse_source_date(pub)) AS days, month_key(parse_source_date(pub)) AS month, thousands(parse_price(price)) AS shown
        FROM listed_fields WHERE parse_price(price) < :cap""", {"listed_fields": fields}, {"run": "2024-03-01", "cap": 900_000}, with_functions=True)


def q_daily_report_or_none(spark, sf_dir):
    """The head line of a date's report from the log, for the last
    week and for a week before the first, on which nothing was collected."""
    with scratch_scope(spark):
        store = _delivered(spark, sf_dir)
        dates = DS.manifest(spark, store).dates()
        out = []
        for d in (dates[0] - _dt.timedelta(days=7), dates[-1]):
            ads = DS.read_clean(spark, store, d)
            lines = RP.no_data_report(spark) if quality.is_empty(ads) else RP.combined_report(ads, d).where(F.col("line").startswith("Total"))
            out.append(lines.select(F.lit(d).alias("run_date"), "line"))
        return pin(out[0].unionByName(out[1]), keep=True)


def q_empty_inputs(spark, sf_dir):
    """A delivery without records leaves the open ads as they were,
    and a table that was never written reads as an empty one of its type."""
    with scratch_scope(spark):
        store = _delivered(spark, sf_dir)
        nothing = DS.deliver(spark, store, DS.read_arrivals(spark, store).where("false"), "nothing")
        never = DS.DeltaStore(scratch_path(spark, "never"))
        removed = SR.empty_table(spark, schemas.REMOVED_ADS).unionByName(DS.read_removed(spark, never)).unionByName(DS.read_removed(spark, store))
        return pin(DS.read_open(spark, store).select(_key(), F.lit("open").alias("state"), F.lit(len(nothing)).alias("applied")).unionByName(
            removed.select(_key(), F.lit("removed").alias("state"), F.lit(len(nothing)).alias("applied"))), keep=True)


def q_table_csv_roundtrip(spark, sf_dir):
    """K5: clean ads written as CSV with a header and read back typed."""
    ads = A.ads_from_part(_table(spark, sf_dir, "part"))
    path = scratch_path(spark, "csv")
    write_table(ads, path, fmt="csv")
    back = spark.read.schema(ads.schema).option("header", True).csv(path)
    return back.select("url_hash", "room_count", "has_lift", "street", "pub_date", "size_sqm", "price_eur", "sqm_price_eur")


def q_cheapest_ads(spark, sf_dir):
    """The first rows of an ordered ad-hoc query (LIMIT is the feature)."""
    return Z.run_sql(spark, "SELECT url_hash, price_eur FROM priced_ads ORDER BY price_eur, url_hash LIMIT 20",
                     {"priced_ads": A.ads_from_part(_table(spark, sf_dir, "part"))})


QUERIES = {
    "daily_report_or_none": q_daily_report_or_none, "empty_inputs": q_empty_inputs, "table_csv_roundtrip": q_table_csv_roundtrip,
    "cheapest_ads": q_cheapest_ads,
    "street_spellings": q_street_spellings, "adhoc_functions": q_adhoc_functions,
    "delta_periods": q_delta_periods, "delta_open_by_date": q_delta_open_by_date, "delta_metrics": q_delta_metrics,
    "stream_lifecycle": q_stream_lifecycle, "open_by_date": q_open_by_date, "digest_changes": q_digest_changes,
    "digest_metrics": q_digest_metrics, "merged_price_stats": q_merged_price_stats, "size_ranges": q_size_ranges,
    "report_positions": q_report_positions, "positional_zip": q_positional_zip, "nested_markup": q_nested_markup,
    "report_file_choice": q_report_file_choice,
}


def oracle(ads_sql, part_sql, islands_sql, status_sql, attrs_sql, price_sql, avg_sql, money_sql, with_) -> dict[str, str]:
    """DuckDB SQL for the queries above, from the catalog's fragments."""
    week = "cast(date_trunc('week', ts) as date)"
    daily = "select distinct user_id as k, cast(ts as date) as d from events"
    to_weekly = lambda s: s.replace(daily, f"select distinct cast(user_id as bigint) * 24 + date_part('hour', ts) as k, {week} as d from events")
    weekly = to_weekly(islands_sql)
    on = "join c on life.list_date <= c.d and (life.removed_date is null or c.d < life.removed_date)"
    counts = """
n as (select d, count(*) filter (where list_date <= d and (removed_date is null or d < removed_date)) as active_total,
             count(*) filter (where list_date = d) as new_ads, count(*) filter (where removed_date = d) as removed from c, life group by d)"""
    price = money_sql("o_totalprice")
    return {
        "delta_periods": with_(weekly) + f"""
select ad_key, {attrs_sql('ad_key', 'list_date')}, list_date, removed_date, days_listed from life""",
        "delta_open_by_date": with_(weekly) + f"""
select c.d as run_date, ad_key, {price_sql('ad_key', 'list_date')} as price, list_date,
       cast(date_diff('day', list_date, c.d) as integer) as days_listed from life {on}""",
        "delta_metrics": with_(weekly + "," + counts) + """
select d as run_date, active_total as scraped, active_total - new_ads + removed as in_db, active_total - new_ads as unchanged, new_ads, removed,
       active_total, cast(sum(removed) over (order by d) as bigint) as removed_total, true as rerun_skipped from n""",
        "stream_lifecycle": with_(islands_sql) + f"""
select ad_key, {attrs_sql('ad_key', 'list_date')}, list_date, removed_date, days_listed from life""",
        "open_by_date": with_(islands_sql) + f"""
select c.d as run_date, ad_key, list_date, cast(date_diff('day', list_date, c.d) as integer) as days_listed from life {on}""",
        "digest_changes": with_(status_sql) + " select ad_key, run_date, status from status where status <> 'still_listed'",
        "digest_metrics": with_(weekly + "," + counts) + """
select d as run_date, active_total - new_ads + removed as in_db, active_total - new_ads as unchanged, new_ads, removed, active_total from n""",
        "merged_price_stats": f"""
select o_orderstatus as segment, count(*) as ad_count, min({price}) as min_price, max({price}) as max_price,
       cast(max({price}) - min({price}) as decimal(18,2)) as price_range, {avg_sql('o_totalprice')} as avg_price
from orders where cast(o_orderdate as date) between date '1995-02-10' and date '1997-02-09' group by 1""",
        "size_ranges": with_(ads_sql) + """
select room_count, cast(floor(size_sqm / 10) * 10 as bigint) as from_size, count(*) as n, min(size_sqm) as min_size, max(size_sqm) as max_size
from ads group by 1, 2""",
        "report_positions": f"""
select p_partkey // {_ADS_PER_FILE} as file, row_number() over (partition by p_partkey // {_ADS_PER_FILE} order by p_partkey) - 1 as pos,
       'p' || p_partkey as url_hash, cast(case when p_brand = 'Brand#13' then 9 else 10 end as integer) as n_lines from part""",
        "positional_zip": with_(part_sql) + f""",
u as (select *, p_partkey // {_ADS_PER_FILE} as file, row_number() over (partition by p_partkey // {_ADS_PER_FILE} order by p_partkey) as rank from part_ads),
v as (select file, price_eur, row_number() over (partition by file order by p_partkey) as rank from u where p_brand <> 'Brand#13')
select file, rank, u.url_hash, v.price_eur, u.room_count from u join v using (file, rank)""",
        "daily_report_or_none": with_(weekly) + """
select cast(min(d) - 7 as date) as run_date, 'No data was collected during last scraping job.' as line from c
union all select max(d), 'Total active listings: ' || (select count(*) from life where removed_date is null) from c""",
        "empty_inputs": with_(weekly) + """
select ad_key, case when removed_date is null then 'open' else 'removed' end as state, cast(0 as integer) as applied from life""",
        "table_csv_roundtrip": with_(ads_sql) + """
select url_hash, room_count, has_lift, street, pub_date, size_sqm, price_eur, sqm_price_eur from ads""",
        "cheapest_ads": with_(ads_sql) + " select url_hash, price_eur from ads order by price_eur, url_hash limit 20",
        "street_spellings": f"""
with recursive b as (select p_partkey, p_name || ' ' || lower(p_type) || ' iela' as s from part),
v as (select p_partkey, s, cast(p_partkey % length(s) as integer) + 1 as at_ from b),
n as (select name, count(*) as n from (select {_MISSPELT.replace("at ", "at_ ").replace("at + 1", "at_ + 1")} as name from v) group by name),
e as (select x.name as a, y.name as b from n x join n y on x.name <> y.name and abs(length(x.name) - length(y.name)) <= 1 and levenshtein(x.name, y.name) <= 1),
reach as (select name as a, name as b from n union select reach.a, e.b from reach join e on reach.b = e.a),
f as (select a as name, min(b) as first from reach group by a),
c as (select first, arg_min(name, (-n, name)) as canonical from n join f using (name) group by first)
select name, canonical, n from n join f using (name) join c using (first)""",
        "adhoc_functions": with_(part_sql) + """
select url_hash, city, price_eur, sqm_price_eur, size_sqm, apt_floor, house_floors, has_lift, street, pub_date,
       strftime(pub_date, '%Y.%m.%d') as stored_date, cast(date '2024-03-01' - pub_date as integer) as days, strftime(pub_date, '%m.%Y') as month,
       replace(format('{:,}', price_eur), ',', ' ') as shown
from part_ads where p_brand <> 'Brand#13' and price_eur < 900000""",
        "nested_markup": """
select p_partkey as page_id, 'https://ss.lv/msg/' || p_partkey || case when p_partkey % 2 = 0 then '?x=1&y=2' else '' end as links,
       p_size || ' €|' || p_partkey as prices, 'lot no ' || p_partkey || ' of "LV"' as note from part""",
        "report_file_choice": """
select 'name' as chosen_by, 'p' || p_partkey as url_hash, date '2024-03-01' as run_date from part where p_partkey % 3 = 2
union all select 'time', 'p' || p_partkey, date '2024-02-29' from part where p_partkey % 3 = 1""",
    }
