"""What many run dates change in the open ads, in one job (J4 over a range).

``lifecycle.lifecycle_step`` applies one date to the open ads; here all dates
of a delivery are applied at once, as events: an ad is inserted, its price is
refreshed, it is removed. An ad that is merely still listed makes no event:
its days on the market follow from its list date, so nothing has to be
written for it.

One aggregation by (ad, date), combined map-side, then one window per ad; a
window holds at most a row per run date.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .lifecycle import LISTED_COLS, listed_row_from_ad

INSERT, REFRESH, REMOVE, UNLISTED = "insert", "refresh", "remove", "unlisted"
VALUES = [c for c in LISTED_COLS if c != "url_hash"]
TRACKED = ("price", "sqm_price")


def days_on(run_date, row: str = "") -> F.Column:
    """J6 without a rewrite: days on the market of an ad still listed on
    ``run_date`` that was stored some dates before."""
    return F.greatest(F.col(row + "days_listed"), F.datediff(run_date, F.col(row + "list_date"))).cast("int").alias("days_listed")


def daily_rows(ads: DataFrame, unparsed: DataFrame) -> DataFrame:
    """One row per (ad, run date): ``t`` the ad's values (the last by
    publication date and address, W3; NULL when no record of it parsed),
    n_parsed and n_today its records."""
    rows = ads.where(F.col("url_hash").isNotNull()).select(*listed_row_from_ad(F.col("run_date")), "url", "run_date")
    blank = unparsed.where(F.col("url_hash").isNotNull()).select("url_hash", "run_date")
    value, parsed = F.struct(*VALUES), F.col("url").isNotNull()
    last = F.max_by(F.when(parsed, value), F.when(parsed, F.struct("list_date", "url", value)))
    return (rows.unionByName(blank, allowMissingColumns=True).groupBy("url_hash", "run_date")
            .agg(last.alias("t"), F.count("url").alias("n_parsed"), F.count(F.lit(1)).alias("n_today")))


def changes(open_before: DataFrame, ads: DataFrame, unparsed: DataFrame, dates: list[_dt.date], before: _dt.date | None,
            track_price: bool = False) -> DataFrame:
    """The events of the run dates ``dates`` (ascending; every date counts as
    a run, also one on which no ad is left) on the ads open after the run of
    ``before``. Columns: op, run_date, url_hash, the values of the open-ads
    table, n_today, n_parsed. A removed ad carries the days it had on its last
    run date; ``unlisted`` rows are records of ads that are not open and did
    not parse (they count as scraped, nothing else)."""
    spark = ads.sparkSession
    known = ([before] if before else [dates[0] - _dt.timedelta(days=1)]) + list(dates)
    calendar = F.broadcast(spark.createDataFrame([(d, i, e) for i, (d, e) in enumerate(zip(known, [*known[1:], None]))],
                                                 "run_date date, idx int, next_date date"))   # a row per date of the delivery
    stored = open_before.select("url_hash", F.lit(known[0]).alias("run_date"), F.struct(*VALUES).alias("t"),
                                F.lit(0).cast("bigint").alias("n_parsed"), F.lit(0).cast("bigint").alias("n_today"))
    rows = daily_rows(ads, unparsed).unionByName(stored).join(calendar, "run_date")
    ad = Window.partitionBy("url_hash").orderBy("idx")
    rows = rows.withColumn("run", F.col("idx") - F.row_number().over(ad))          # equal on consecutive run dates
    stretch = Window.partitionBy("url_hash", "run").orderBy("idx")
    upto = stretch.rowsBetween(Window.unboundedPreceding, 0)
    earlier = stretch.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select("*", F.first("t", ignorenulls=True).over(upto).alias("f"),
                       F.last("t", ignorenulls=True).over(upto).alias("l"), F.last("t", ignorenulls=True).over(earlier).alias("e"),
                       F.lead("idx").over(stretch).isNull().alias("ends"))
    kept = F.struct(*[F.col(("l." if track_price and c in TRACKED else "f.") + c).alias(c) for c in VALUES])
    gone = F.struct(*[days_on(F.col("run_date"), "f.") if c == "days_listed" else kept[c].alias(c) for c in VALUES])
    begins, listed, today = F.col("e").isNull() & F.col("f").isNotNull(), F.col("f").isNotNull(), F.col("idx") > 0
    moved = F.lit(False)
    if track_price:
        differs = [~F.col(f"l.{c}").eqNullSafe(F.col(f"e.{c}")) for c in TRACKED]
        moved = listed & ~begins & (differs[0] | differs[1])

    def event(when, op, date, row):
        return F.when(when, F.struct(F.lit(op).alias("op"), date.alias("run_date"), row.alias("row"),
                                     F.col("n_today").alias("n_today"), F.col("n_parsed").alias("n_parsed")))

    events = F.array_compact(F.array(
        event(today & begins, INSERT, F.col("run_date"), F.col("f")),
        event(today & moved, REFRESH, F.col("run_date"), kept),
        event(today & ~listed, UNLISTED, F.col("run_date"), F.lit(None).cast(rows.schema["t"].dataType)),
        event(listed & F.col("ends") & F.col("next_date").isNotNull(), REMOVE, F.col("next_date"), gone)))
    return rows.select("url_hash", F.explode(events).alias("v")).select(
        "v.op", "v.run_date", "url_hash", *[F.col("v.row")[c].alias(c) for c in VALUES], "v.n_today", "v.n_parsed")
