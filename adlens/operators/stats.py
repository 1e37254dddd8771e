"""Aggregations, sorts, limits and set operations (A1-A13, O1-O6, U1-U4,
X1-X7, X9, X10).

Every aggregate is a plain ``groupBy``/``rollup`` (partial aggregation
map-side, final after the shuffle), never a per-segment collected list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

ALL_SEGMENTS = "all"
OTHER_SEGMENT = "other"   # non-numeric room labels, listed after the numbers (Q21)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def price_aggs(price, money_type: str = "decimal(18,2)") -> list[Column]:
    """A1 measures: count, min, max, range, average rounded to 2 decimals.
    The average is sum / count over exact decimals, rounded half-up (Q10)."""
    p = _c(price).cast(money_type)
    return [
        F.count(p).alias("ad_count"),
        F.min(p).alias("min_price"),
        F.max(p).alias("max_price"),
        (F.max(p) - F.min(p)).cast(money_type).alias("price_range"),
        F.round(F.sum(p) / F.count(p), 2).cast(money_type).alias("avg_price"),
    ]


def price_stats(df: DataFrame, segment, price, with_total: bool = False,
                money_type: str = "decimal(18,2)") -> DataFrame:
    """A1 (+A4): price statistics per segment; ``with_total`` adds the
    grand-total row (segment NULL, ``is_total`` true) through ``rollup``."""
    if not isinstance(segment, str):
        df, segment = df.withColumn("segment", segment), "segment"
    if with_total:
        return (df.rollup(segment)
                .agg(*price_aggs(price, money_type), F.grouping(segment).cast("boolean").alias("is_total")))
    return df.groupBy(segment).agg(*price_aggs(price, money_type))


def price_stat_table(stats: DataFrame, segment: str) -> DataFrame:
    """The stat table with the report's column names, segments in
    numeric order then the total (labelled 'all')."""
    seg = (F.when(F.col("is_total"), F.lit(ALL_SEGMENTS))
           .otherwise(F.coalesce(F.col(segment).cast("string"), F.lit(OTHER_SEGMENT))))
    return stats.select(seg.alias("Room Segment"), F.col("ad_count").alias("Ad count"),
                        F.col("min_price").alias("Min Price"), F.col("max_price").alias("Max Price"),
                        F.col("price_range").alias("Price Range"), F.col("avg_price").alias("Avg Price"),
                        F.col("is_total"), F.col(segment).alias("_seg")) \
        .orderBy("is_total", F.asc_nulls_last("_seg")).drop("is_total", "_seg")


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """A9 (+O4): ``SELECT c, COUNT(c) … GROUP BY c ORDER BY COUNT(c) DESC``;
    COUNT(c) is 0 for the NULL group; ties broken by value. ``top`` keeps
    the first n (TakeOrderedAndProject, no global sort of all groups)."""
    out = df.groupBy(column).agg(F.count(column).alias("cnt"))
    ordered = out.orderBy(F.desc("cnt"), F.asc_nulls_last(column))
    return ordered.limit(top) if top else ordered


def pub_date_counts(df: DataFrame, date_col: str = "pub_date") -> DataFrame:
    """A5: ads per publication date, with the month key."""
    return df.groupBy(F.col(date_col).alias("pub_date")).agg(F.count(F.lit(1)).alias("ad_count")) \
        .select("pub_date", X.month_key("pub_date").alias("month_key"), "ad_count")


def month_counts(df: DataFrame, date_col: str = "pub_date") -> DataFrame:
    """Per month (chronological, Q14): number of distinct dates and ads."""
    return (df.groupBy(X.month_start(date_col).alias("month_start"))
            .agg(F.count_distinct(date_col).alias("n_dates"), F.count(F.lit(1)).alias("ad_count"))
            .select("month_start", X.month_key("month_start").alias("month_key"), "n_dates", "ad_count"))


def distinct_months(df: DataFrame, date_col: str = "pub_date") -> DataFrame:
    """The distinct months, chronological."""
    return df.select(X.month_start(date_col).alias("month_start")).distinct() \
        .select("month_start", X.month_key("month_start").alias("month_key")).orderBy("month_start")


def avg_by(df: DataFrame, keys: list, value, money_type: str = "decimal(18,2)") -> DataFrame:
    """A10: count and average (2 decimals) of ``value`` per keys."""
    v = _c(value).cast(money_type)
    return df.groupBy(*keys).agg(F.count(v).alias("n"),
                                 F.round(F.sum(v) / F.count(v), 2).cast(money_type).alias("avg_price"))


def table_counts(listed: DataFrame, removed: DataFrame, cap: int = 500_000,
                 price: str = "price") -> DataFrame:
    """Active listings, removed ads, removed ads under the price
    cap (Q15: the reference's number leaves out NULL and capped prices)."""
    a = listed.agg(F.count(F.lit(1)).alias("active_total"))
    r = removed.agg(F.count(F.lit(1)).alias("removed_total"),
                    F.count_if(F.col(price) < cap).alias("removed_under_cap"))
    return a.crossJoin(r)  # two single-row aggregates


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct segment values, ordered."""
    return df.select(column).distinct().orderBy(column)


def digit_room_values(df: DataFrame, label: str = "room_label") -> DataFrame:
    """Distinct room labels made of digits only, as INT, ordered."""
    return (df.where(F.col(label).rlike("^[0-9]+$"))
            .select(F.col(label).try_cast("int").alias("room_count")).distinct().orderBy("room_count"))


def share_of_total(df: DataFrame, column: str) -> DataFrame:
    """Count and percent of all rows per value. The total is a one-row
    aggregate joined onto the groups (no single-partition window)."""
    g = df.groupBy(column).agg(F.count(F.lit(1)).alias("cnt"))
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    pct = F.round(F.col("cnt").cast("decimal(20,0)") * 100 / F.col("_total"), 2).cast("decimal(9,2)")
    return g.crossJoin(F.broadcast(total)).select(column, "cnt", pct.alias("pct"))


def size_stats(df: DataFrame, segment: str = "room_count", size: str = "size_sqm") -> DataFrame:
    """Min / max / average size per segment."""
    s = F.col(size).cast("decimal(10,2)")
    return df.groupBy(segment).agg(F.count(s).alias("n"), F.min(s).alias("min_size"), F.max(s).alias("max_size"),
                                   F.round(F.sum(s) / F.count(s), 2).cast("decimal(10,2)").alias("avg_size"))


def scatter_bins(df: DataFrame, segment: str, size: str, price: str,
                 size_width: int = 10, price_width: int = 100_000) -> DataFrame:
    """The data behind the size/price scatter, as bins per segment."""
    sb = (F.floor(F.col(size) / size_width) * size_width).cast("bigint")
    pb = (F.floor(F.col(price) / price_width) * price_width).cast("bigint")
    return df.groupBy(segment, sb.alias("size_bin"), pb.alias("price_bin")).agg(F.count(F.lit(1)).alias("n"))


def sqm_price_ranges(df: DataFrame, segment: str = "room_count", price: str = "sqm_price_eur", width: int = 500) -> DataFrame:
    """Per segment the ads in each range of m²-prices of ``width``, with
    the lowest and highest m²-price; ads without one are left out."""
    low = (F.floor(F.col(price) / width) * width).cast("bigint")
    return (df.where(F.col(price).isNotNull()).groupBy(segment, low.alias("from_price"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(price).alias("min_sqm_price"), F.max(price).alias("max_sqm_price")))


def size_ranges(df: DataFrame, segment: str = "room_count", size: str = "size_sqm", width: int = 10) -> DataFrame:
    """Per segment the ads in each range of sizes of ``width`` m², with
    the smallest and largest size; ads without a size are left out."""
    low = (F.floor(F.col(size) / width) * width).cast("bigint")
    return (df.where(F.col(size).isNotNull()).groupBy(segment, low.alias("from_size"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(size).alias("min_size"), F.max(size).alias("max_size")))


def floor_filter(df: DataFrame, apt: str = "apt_floor", house: str = "house_floors",
                 skip_house_floors: int = 9) -> DataFrame:
    """Drop first-floor, last-floor and 9-floor-house ads."""
    return df.where((F.col(apt) > 1) & (F.col(apt) < F.col(house)) & (F.col(house) != skip_house_floors))


def street_name(c) -> Column:
    """Street without the house number (trailing number tokens)."""
    return F.trim(F.regexp_replace(_c(c), r"(\s+\d[\w/.-]*)+\s*$", ""))


def street_stats(df: DataFrame, street: str = "street", price: str = "price_eur") -> DataFrame:
    """Ads and average price per street (house number removed)."""
    return avg_by(df.withColumn("street_name", street_name(street)), ["street_name"], price)


def last_days(df: DataFrame, date_col: str, run_date, days: int) -> DataFrame:
    """Rows of the last ``days`` days up to the run date (pushable)."""
    run = X.run_date_lit(run_date)
    return df.where((F.col(date_col) > F.date_sub(run, days)) & (F.col(date_col) <= run))


def union_distinct(*dfs: DataFrame) -> DataFrame:
    """U1+U2: union all, then distinct."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out.distinct()
