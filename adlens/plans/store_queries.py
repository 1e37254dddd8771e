"""Registered queries over the state store and over pages and files that are
rendered from the driver's tables; their SQL is put together in ``oracle``.
"""

from __future__ import annotations


from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import text as X
from ..operators import extract as E
from ..operators import lifecycle as L
from ..operators import stats as ST
from ..operators.sizing import pin, spread
from ..session import scratch_path, scratch_scope
from ..sources import reports as SR
from . import adapters as A
from . import daily as D


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _weekly(spark, sf_dir):
    return A.weekly_ads_from_events(_table(spark, sf_dir, "events"))


def _as_tagged(ads):
    """Clean ads as the parser's tagged rows."""
    return ads.withColumn("source_file", F.lit("events")).withColumn("_block", F.lit(None).cast("string")).withColumn(
        "_reason", F.lit(None).cast("string"))


def q_store_periods(spark, sf_dir):
    """K6-K11, S7, S8, S11, ST1-ST3: weekly event ads delivered to a state
    store in two parts; half of the second week comes late, with the last
    week. Open ads and removal history together are the listing periods."""
    tagged = _as_tagged(A.ads_from_snapshots(_weekly(spark, sf_dir)))
    with scratch_scope(spark):
        rows = pin(tagged)
        weeks = sorted(r["run_date"] for r in rows.select("run_date").distinct().collect())
        late = ((F.col("run_date") == F.lit(weeks[min(1, len(weeks) - 1)])) & (F.col("url_hash").cast("bigint") % 2 == 1)) | (
            F.col("run_date") == F.lit(weeks[-1]))
        store = D.StateStore(scratch_path(spark, "store"))
        D.apply_arrivals(spark, store, rows.where(~late), "first", keep_clean=False)
        D.apply_arrivals(spark, store, rows.where(late), "second", keep_clean=False)
        columns = ["room_count", "house_floors", "apt_floor", "price", "sqm", "sqm_price", "apt_address"]
        key = F.col("url_hash").cast("bigint").alias("ad_key")
        open_ = D.read_listed(spark, store).select(key, *columns, "list_date", F.lit(None).cast("date").alias("removed_date"), "days_listed")
        gone = D.read_removed(spark, store).select(key, *columns, F.col("listed_date").alias("list_date"), "removed_date", "days_listed")
        return pin(open_.unionByName(gone), keep=True)


def q_unparsed_still_listed(spark, sf_dir):
    """J4 where every seventh ad of the last week did not parse: open ones
    among them stay listed, new ones are not inserted, none is removed."""
    weekly = _weekly(spark, sf_dir)
    last = weekly.agg(F.max("run_date").alias("d")).first()["d"]
    prev = A.open_ads_as_listed(L.lifecycle_backfill(weekly.where(F.col("run_date") < F.lit(last))))
    ads = A.ads_from_snapshots(weekly.where(F.col("run_date") == F.lit(last)))
    bad = F.col("url_hash").cast("bigint") % 7 == 0
    step = L.lifecycle_step(prev, ads.where(~bad), last, persist=False, unparsed=ads.where(bad))
    key = F.col("url_hash").cast("bigint").alias("ad_key")
    open_ = step.listed_next.select(key, "price", "list_date", F.lit(None).cast("date").alias("removed_date"), "days_listed")
    gone = step.removed_delta.select(key, "price", F.col("listed_date").alias("list_date"), "removed_date", "days_listed")
    return open_.unionByName(gone)


def q_unparsed_metrics(spark, sf_dir):
    """A12 of the step above."""
    weekly = _weekly(spark, sf_dir)
    last = weekly.agg(F.max("run_date").alias("d")).first()["d"]
    prev = A.open_ads_as_listed(L.lifecycle_backfill(weekly.where(F.col("run_date") < F.lit(last))))
    ads = A.ads_from_snapshots(weekly.where(F.col("run_date") == F.lit(last)))
    bad = F.col("url_hash").cast("bigint") % 7 == 0
    step = L.lifecycle_step(prev, ads.where(~bad), last, persist=False, unparsed=ads.where(bad))
    return step.metrics.select("run_date", "in_db", "unchanged", "new_ads", "removed", "active_total")


def q_sqm_price_ranges(spark, sf_dir):
    """Ranges of m²-prices per room segment."""
    return ST.sqm_price_ranges(A.ads_from_part(_table(spark, sf_dir, "part")))


def _mixed_pages(spark, sf_dir):
    """Pages from ``part`` whose markup mixes quotes, letter case, attribute
    order and a second table; what they hold follows from the key."""
    k = F.col("p_partkey").cast("string")
    lot = F.concat(F.lit("LV"), k)
    html = F.concat(
        F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("<a data-href=\"/msg/no\" class='x' href='/msg/"), k, F.lit("?a=1&amp;b=2'>x</a>")))
        .otherwise(F.concat(F.lit("<A HREF=\"/msg/"), k, F.lit("\" data-href='/msg/no'>x</A><a title='href=\"/msg/no\"'>y</a>"))),
        F.lit("<table class=t ID='page_main'><tr><TD data-class='ads_price' class='x ads_price'>"), F.col("p_size").cast("string"),
        F.lit("</TD></tr><tr><td class=ads_opt_name>Kadastra numurs:</td><td class='ads_opt'>"), lot,
        F.lit("</td></tr><tr><td><table><tr><td class=\"ads_price\">in</td></tr></table></td></tr></table>"
              "<table><tr><td class='ads_price'>out</td></tr></table><SPAN data-id='note' class='n' id='note'>lot <b>"), lot, F.lit("</b></SPAN>"))
    return pin(spread(_table(spark, sf_dir, "part")).select(F.col("p_partkey").alias("page_id"), html.alias("html")))


def q_mixed_markup(spark, sf_dir):
    """H1, H4, H5, H7 on pages of mixed markup: the page's links, price cells
    of the main table, the note's text, and the X8 label."""
    pages = _mixed_pages(spark, sf_dir)
    cells = H.cells("html", "td", H.CLASS_OPT_VALUE, scoped=True)
    return pages.select("page_id", F.array_join(H.msg_links("html"), " ").alias("links"),
                        F.array_join(H.cells("html", "td", H.CLASS_PRICE, scoped=True), "|").alias("prices"),
                        H.span_text("html", "note").alias("note"), F.get(cells, 0).alias("cadastre"))


def q_cadastre_label(spark, sf_dir):
    """An optional label of a report (``Kadastra numurs``) rendered,
    written and read back by name."""
    path = scratch_path(spark, "cadastre")
    part = spread(_table(spark, sf_dir, "part"))
    blocks = A.report_blocks_from_part(part.select("*")).select(
        F.concat("block", F.lit("\nKadastra numurs:>LV"), F.regexp_extract("block", r"/p(\d+)\.html", 1)).alias("block"))
    blocks.write.mode("overwrite").text(path)
    parsed = SR.parse_blocks(SR.read_report_blocks(spark, path, run_date=A.PART_PUB_DATE_ANCHOR))
    return parsed.select(X.url_hash("url").alias("url_hash"), H.field("fields", "Kadastra numurs").alias("cadastre"))


def q_report_files_by_date(spark, sf_dir):
    """Report files of two dates; the ads of the file that its name
    selects, from the listing alone, and whether a latest file was found."""
    root = scratch_path(spark, "reports")
    part = spread(_table(spark, sf_dir, "part"))
    blocks = A.report_blocks_from_part(part)
    even = F.regexp_extract("block", r"/p(\d+)\.html", 1).cast("bigint") % 2 == 0
    for day, rows in (("2024-02-29", blocks.where(~even)), ("2024-03-01", blocks.where(even))):
        rows.write.mode("overwrite").text(f"{root}/report-{day}")
    picked = SR.files_for_run_date(spark, f"{root}/report-2024-03-01", "part-").agg(F.count(F.lit(1)).alias("files"))
    latest = SR.latest_file(spark, f"{root}/*").agg(F.count(F.lit(1)).alias("latest"))
    ads = SR.read_report_blocks(spark, f"{root}/report-2024-03-01", run_date="2024-03-01")
    found = ads.select(X.url_hash(H.block_url("block")).alias("url_hash"), "run_date")
    return found.crossJoin(picked).crossJoin(latest).select("url_hash", "run_date", (F.col("files") > 0).alias("listed"), "latest")


def q_all_links(spark, sf_dir):
    """Links of the stored pages and the pages' own addresses as one
    list, each once."""
    pages = spread(SR.read_pages(spark, f"{sf_dir.rstrip('/')}/pages.parquet"))
    links = pages.select(F.explode(H.links("html")).alias("link"))
    return ST.union_distinct(links, pages.select(F.col("url").alias("link")).where("link is not null"))


QUERIES = {
    "store_periods": q_store_periods,
    "unparsed_still_listed": q_unparsed_still_listed,
    "unparsed_metrics": q_unparsed_metrics,
    "sqm_price_ranges": q_sqm_price_ranges,
    "mixed_markup": q_mixed_markup,
    "cadastre_label": q_cadastre_label,
    "report_files_by_date": q_report_files_by_date,
    "all_links": q_all_links,
}


def oracle(ads_sql, part_sql, islands_sql, days_sql, attrs_sql, price_sql, with_) -> dict[str, str]:
    """DuckDB SQL for the queries above, from the catalog's fragments."""
    week = "cast(date_trunc('week', ts) as date)"
    weekly = islands_sql.replace("select distinct user_id as k, cast(ts as date) as d from events",
                                 f"select distinct cast(user_id as bigint) * 24 + date_part('hour', ts) as k, {week} as d from events")
    last = "(select max(d) from c)"
    return {
        "store_periods": with_(weekly) + f"""
select ad_key, {attrs_sql('ad_key', 'list_date')}, list_date, removed_date, days_listed from life""",
        "unparsed_still_listed": with_(weekly) + f"""
select ad_key, {price_sql('ad_key', 'list_date')} as price, list_date, removed_date, days_listed from life
where (removed_date is null and not (ad_key % 7 = 0 and list_date = {last})) or removed_date = {last}""",
        "unparsed_metrics": with_(weekly) + f"""
select {last} as run_date, count(*) filter (where list_date < {last} and (removed_date is null or removed_date = {last})) as in_db,
       cast(count(*) filter (where list_date < {last} and removed_date is null) as bigint) as unchanged,
       cast(count(*) filter (where list_date = {last} and ad_key % 7 <> 0) as bigint) as new_ads,
       count(*) filter (where removed_date = {last}) as removed,
       count(*) filter (where removed_date is null and not (ad_key % 7 = 0 and list_date = {last})) as active_total
from life""",
        "sqm_price_ranges": with_(ads_sql) + """
select room_count, cast(floor(sqm_price_eur / 500) * 500 as bigint) as from_price, count(*) as n,
       min(sqm_price_eur) as min_sqm_price, max(sqm_price_eur) as max_sqm_price from ads group by 1, 2""",
        "mixed_markup": """
select p_partkey as page_id,
       'https://ss.lv/msg/' || p_partkey || case when p_partkey % 2 = 0 then '?a=1&b=2' else '' end as links,
       p_size || '|in' as prices, 'lot LV' || p_partkey as note, 'LV' || p_partkey as cadastre from part""",
        "cadastre_label": "select 'p' || p_partkey as url_hash, 'LV' || p_partkey as cadastre from part",
        "report_files_by_date": "select 'p' || p_partkey as url_hash, date '2024-03-01' as run_date, true as listed, "
                                "cast(1 as bigint) as latest from part where p_partkey % 2 = 0",
        "all_links": """
select distinct link from (select unnest(regexp_extract_all(html, '<a\\b[^>]*\\bhref="([^"]*)"', 1)) as link from pages
                           union all select url from pages where url is not null)""",
    }
