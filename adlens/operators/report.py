"""Reports as queries (R1-R6, F15): every report is a DataFrame of lines
with typed ordering columns beside the text; exporting it is a text write
(K4). Nothing is assembled on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from .ranking import rank_within
from .sizing import bounded_broadcast, pin

# --- fixed values: report texts ----------------------------------------------
SEGMENT_TITLE = "{} room apartment segment:"
COLUMN_LINE = "[Rooms, Floor, Size, Price EUR, SQM Price EUR, Apartment Street, Pub_date,  URL]"
NEW_MARKER = " [NEW]"
TOTAL_LINE = "Total active listings: {}"
MONTH_LINE = "--- Month: {} ---"
PUB_DATE_LINE = "Pub_date: {} ->  Listed add count: {} "
METRICS_LINE = "{}: Scraped today: {} | In DB: {} | Unchanged: {} | New ads: {} | Removed: {}"
COUNTS_LINE = "Active listings in DB: {} | Removed ads in DB: {}"
NO_DATA_LINE = "No data was collected during last scraping job."
# -------------------------------------------------------------------------------

LINE_COLS = ["section", "segment", "line_no", "line_kind", "line"]
TOTAL_LINE_NO = 2**31 - 1
TEXT_SEGMENT = 2**30   # segment keys of non-numeric room labels follow this one


def _lines(df: DataFrame, section: int, segment, line_no, kind: str, line) -> DataFrame:
    return df.select(F.lit(section).cast("int").alias("section"), segment.cast("int").alias("segment"),
                     line_no.cast("bigint").alias("line_no"), F.lit(kind).alias("line_kind"),
                     line.alias("line"))


def ad_line(run_date) -> F.Column:
    """one ad line; '[NEW]' when published on the run date (P11). A
    missing value leaves its place empty, the line stays."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    floor = F.concat_ws("/", F.col("apt_floor").cast("string"), F.col("house_floors").cast("string"))
    rooms = F.coalesce(F.col("room_count").cast("string"), F.col("room_label"), F.lit(""))
    date = F.coalesce(X.format_source_date("pub_date"), F.lit(""))
    new = F.when(F.col("pub_date") == X.run_date_lit(run_date), F.lit(NEW_MARKER)).otherwise(F.lit(""))
    return F.concat(F.lit("  "), rooms, F.lit("     "), floor, F.lit("    "),
                    part("size_sqm"), F.lit("   "), part("price_eur"),
                    F.lit(" EUR    "), part("sqm_price_eur"), F.lit(" EUR   "),
                    part("street"), F.lit("   "), date, F.lit(" "), part("url"), new)


def _keyed(ads: DataFrame) -> DataFrame:
    """Add ``_label``: the room label an ad without a number is grouped by."""
    label = F.col("room_label") if "room_label" in ads.columns else F.lit(None).cast("string")
    return ads.withColumn("room_label", label).withColumn(
        "_label", F.when(F.col("room_count").isNull(), F.coalesce(label, F.lit(""))))


def segments(ads: DataFrame) -> DataFrame:
    """One row per room segment, numbers first, then each text label in its
    order (Q21): ``room_count``, ``_label``, ``segment`` (its sort key),
    ``title`` and the price statistics. One pass over the ads; the window
    holds one row per segment."""
    per = _keyed(ads).groupBy("room_count", "_label").agg(
        F.count(F.lit(1)).alias("ad_count"), F.count("price_eur").alias("_priced"),
        F.min("price_eur").alias("min_price"), F.max("price_eur").alias("max_price"),
        F.sum(F.col("price_eur").cast("decimal(38,2)")).alias("_sum"))
    place = F.row_number().over(Window.orderBy(F.col("room_count").isNull(), "_label"))
    return per.select("*", F.coalesce("room_count", F.lit(TEXT_SEGMENT) + place).alias("segment"),
                      F.coalesce(F.col("room_count").cast("string"), F.col("_label")).alias("title"))


def ads_by_segment(ads: DataFrame, run_date, title: str | None = None, known: DataFrame | None = None) -> DataFrame:
    """Header (title, total), then per room segment a title line, the
    column line and the ads by price (tie-break url_hash, Q16).
    ``known``: pinned ``segments`` of the same ads.
    Columns: section, segment, line_no, line_kind, line."""
    known = pin(segments(ads)) if known is None else known
    place = bounded_broadcast(known.select("room_count", "_label", "segment")).alias("s")
    keyed = _keyed(ads).alias("a").join(place, F.expr("a.room_count <=> s.room_count and a._label <=> s._label")).select("a.*", "s.segment")
    ranked = rank_within(keyed, ["segment"], ["price_eur", "url_hash"], "rank_in_segment")
    ad_rows = _lines(ranked, 1, F.col("segment"), F.col("rank_in_segment"), "ad", ad_line(run_date))
    seg_title = F.format_string(SEGMENT_TITLE.replace("{}", "%s"), F.col("title"))
    titles = _lines(known, 1, F.col("segment"), F.lit(-1), "segment_title", seg_title)
    cols = _lines(known, 1, F.col("segment"), F.lit(0), "column_line", F.lit(COLUMN_LINE))
    total = known.agg(F.coalesce(F.sum("ad_count"), F.lit(0)).cast("bigint").alias("n"))
    head = [_lines(total, 0, F.lit(None), F.lit(2), "total",
                   F.format_string(TOTAL_LINE.replace("{}", "%d"), F.col("n")))]
    if title is not None:
        head.append(_lines(total, 0, F.lit(None), F.lit(1), "title",
                           F.lit(title.format(date=str(run_date)))))
    out = ad_rows.unionByName(titles).unionByName(cols)
    for h in head:
        out = out.unionByName(h)
    return out


def ads_table(ads: DataFrame) -> DataFrame:
    """R2: digit-room ads with the report's column names, by segment and price."""
    rows = ads.where(F.col("room_label").rlike("^[0-9]+$"))
    return rows.select(
        F.col("room_count").alias("Rooms"),
        F.concat_ws("/", F.col("apt_floor").cast("string"), F.col("house_floors").cast("string")).alias("Floor"),
        F.col("size_sqm").alias("Size"), F.col("price_eur").alias("Price"),
        F.col("sqm_price_eur").alias("SQM Price"), F.col("street").alias("Apartment Street"),
        X.format_source_date("pub_date").alias("Pub_date"), F.col("url").alias("URL"),
        F.col("url_hash")).orderBy("Rooms", "Price", "url_hash").drop("url_hash")


def pub_date_report(ads: DataFrame, date_col: str = "pub_date") -> DataFrame:
    """Per month (chronological) a header, then 'Pub_date: d -> count'
    lines by date. Columns: month_start, pub_date, line."""
    per_day = ads.groupBy(F.col(date_col).alias("pub_date")).agg(F.count(F.lit(1)).alias("n"))
    day_lines = per_day.select(X.month_start("pub_date").alias("month_start"), "pub_date",
                               F.format_string(PUB_DATE_LINE.replace("{}", "%s"), X.format_source_date("pub_date"),
                                               F.col("n").cast("string")).alias("line"))
    months = per_day.select(X.month_start("pub_date").alias("month_start")).distinct()
    month_lines = months.select("month_start", F.lit(None).cast("date").alias("pub_date"),
                                F.format_string(MONTH_LINE.replace("{}", "%s"), X.month_key("month_start")).alias("line"))
    return month_lines.unionByName(day_lines)


def run_history(metrics: DataFrame) -> DataFrame:
    """One metrics line per run plus the table counts line."""
    line = F.format_string(METRICS_LINE.replace("{}", "%s"), X.format_source_date("run_date"),
                           *[F.col(c).cast("string") for c in ["scraped", "in_db", "unchanged", "new_ads", "removed"]])
    # the reference's "Removed ads in DB" counts prices under the cap only (Q15)
    removed = "removed_under_cap" if "removed_under_cap" in metrics.columns else "removed_total"
    counts = F.format_string(COUNTS_LINE.replace("{}", "%s"), F.col("active_total").cast("string"),
                             F.col(removed).cast("string"))
    return metrics.select("run_date", line.alias("line"), counts.alias("counts_line"))


def combined_report(ads: DataFrame, run_date, metrics: DataFrame | None = None,
                    title: str | None = None) -> DataFrame:
    """R1, then R3-like stats lines, R4 and R5 as sections of one line
    table; a missing part is skipped. Order by section, segment, line_no."""
    known = pin(segments(ads))   # titles, total and statistics from one pass
    r1 = ads_by_segment(ads, run_date, title, known)
    money = lambda c: F.col(c).cast("decimal(18,2)")
    # an exact average, half-up in cents, as the statistics table has it
    mean = F.expr("cast((2 * (_sum * 100) + _priced) div nullif(2 * _priced, 0) as decimal(38,0)) / 100").cast("decimal(18,2)")
    sums = [F.sum("ad_count").alias("ad_count"), F.sum("_priced").alias("_priced"), F.min("min_price").alias("min_price"),
            F.max("max_price").alias("max_price"), F.sum("_sum").alias("_sum")]
    whole = known.agg(*sums).where("ad_count is not null").select(
        F.lit(TOTAL_LINE_NO).alias("segment"), F.lit("all").alias("title"), "ad_count", "_priced", "min_price", "max_price", "_sum")
    st = known.select(*whole.columns).unionByName(whole)
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    stat_line = F.format_string("%s | %s | %s | %s | %s | %s", F.col("title"), F.col("ad_count").cast("string"),
                                text(money("min_price")), text(money("max_price")),
                                text(money("max_price") - money("min_price")), text(mean))
    # stat lines are ordered by line_no: numbers, text labels, the total last
    r3 = _lines(st, 2, F.lit(None), F.col("segment"), "stat", stat_line)
    r4 = pub_date_report(ads)
    r4 = r4.select(F.lit(3).alias("section"), F.lit(None).cast("int").alias("segment"),
                   (F.unix_date("month_start").cast("bigint") * 100000
                    + F.coalesce(F.unix_date("pub_date").cast("bigint") - F.unix_date("month_start") + 1, F.lit(0))).alias("line_no"),
                   F.lit("pub_date").alias("line_kind"), "line")
    out = r1.unionByName(r3).unionByName(r4)
    if metrics is not None:
        r5 = run_history(metrics)
        out = out.unionByName(_lines(r5, 4, F.lit(None), F.unix_date("run_date"), "run", F.col("line")))
    return out


def no_data_report(spark) -> DataFrame:
    """V4: the fallback report when no data was collected."""
    return spark.createDataFrame([(0, None, 0, "no_data", NO_DATA_LINE)],
                                 "section int, segment int, line_no bigint, line_kind string, line string")
