"""Listing lifecycle: snapshot diff, new/removed/still-listed ads, the daily
lifecycle step, and the multi-day backfill (J1-J6, W3, W4, U3, U4, A12).

Scale notes
* Today's ads are deduplicated per key with an aggregate (``max_by``), which
  is combined map-side, so a key holding a third of all rows is cheap.
* The daily step is one full outer join of two key-unique sides (no skew).
* Multi-day forms use windows partitioned by the ad key over distinct
  (key, day) rows: a window holds at most one row per snapshot day.
* The only global structure is the table of distinct snapshot days; it is
  pinned and broadcast behind a row-count check.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions import text as X
from .sizing import bounded_broadcast, pin

# --- fixed values: price cap of the removed-ads count, status words ---------
PRICE_CAP = 500_000
NEW, STILL, REMOVED = "new", "still_listed", "removed"


# --- J1 / U3 / U4 -----------------------------------------------------------------

def snapshot_diff(today: DataFrame, prev: DataFrame, key: str = "url_hash") -> DataFrame:
    """(key, status, n_today). new = today minus prev, still_listed =
    in both, removed = prev minus today. Duplicates in today are counted in
    ``n_today`` (the reference counts them) but give one row."""
    t = today.groupBy(key).agg(F.count(F.lit(1)).alias("n_today"))
    p = prev.select(key).distinct().withColumn("_in_prev", F.lit(True))
    j = t.join(p, key, "full_outer")
    status = (F.when(F.col("_in_prev").isNull(), F.lit(NEW))
              .when(F.col("n_today").isNull(), F.lit(REMOVED))
              .otherwise(F.lit(STILL)))
    return j.select(key, status.alias("status"), F.coalesce("n_today", F.lit(0)).alias("n_today"))


def new_keys(today: DataFrame, prev: DataFrame, key: str = "url_hash") -> DataFrame:
    """today's rows whose key is not open (anti join, duplicates kept)."""
    return today.join(prev.select(key), key, "left_anti")


def removed_keys(today: DataFrame, prev: DataFrame, key: str = "url_hash") -> DataFrame:
    """Open rows whose key is not in today's data."""
    return prev.join(today.select(key), key, "left_anti")


def still_listed(today: DataFrame, prev: DataFrame, key: str = "url_hash") -> DataFrame:
    """Open rows whose key is in today's data (semi join)."""
    return prev.join(today.select(key), key, "left_semi")


def diff_metrics(status: DataFrame) -> DataFrame:
    """Scraped / in_db / unchanged / new / removed from a J1 result."""
    return status.agg(
        F.sum("n_today").cast("bigint").alias("scraped"),
        F.count_if(F.col("status") != NEW).alias("in_db"),
        F.coalesce(F.sum(F.when(F.col("status") == STILL, F.col("n_today"))), F.lit(0)).cast("bigint").alias("unchanged"),
        F.coalesce(F.sum(F.when(F.col("status") == NEW, F.col("n_today"))), F.lit(0)).cast("bigint").alias("new_ads"),
        F.count_if(F.col("status") == REMOVED).alias("removed"))


# --- W3 --------------------------------------------------------------------------

def last_per_key(df: DataFrame, key, order: list) -> DataFrame:
    """The last row per key by ``order`` (all descending tie-breaks are
    part of ``order``). An aggregate, combined map-side: no window, no
    single task per hot key."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    value = F.struct(*rest)
    best = F.max_by(value, F.struct(*[F.col(c) for c in order], value))   # value breaks ties: total order
    return df.groupBy(*keys).agg(best.alias("_r")).select(*keys, *[F.col("_r." + c).alias(c) for c in rest])


# --- J2-J6: the daily step ---------------------------------------------------------

def listed_row_from_ad(run_date) -> list[Column]:
    """Derive an open-ads row from a clean ad."""
    return [
        F.col("url_hash"),
        F.col("room_count").cast("int").alias("room_count"),
        F.col("house_floors").cast("int").alias("house_floors"),
        F.col("apt_floor").cast("int").alias("apt_floor"),
        F.col("price_eur").try_cast("bigint").alias("price"),
        F.round(F.col("size_sqm")).try_cast("bigint").alias("sqm"),
        F.round(F.col("sqm_price_eur")).try_cast("bigint").alias("sqm_price"),
        F.col("street").alias("apt_address"),
        F.col("pub_date").alias("list_date"),
        X.days_listed(run_date, "pub_date").cast("int").alias("days_listed"),
        F.lit(None).cast("int").alias("view_count"),
    ]


# fixed values: the columns of the open-ads table
LISTED_COLS = ["url_hash", "room_count", "house_floors", "apt_floor", "price", "sqm", "sqm_price",
               "apt_address", "list_date", "days_listed", "view_count"]


@dataclass
class StepResult:
    listed_next: DataFrame   # D5 after the run
    removed_delta: DataFrame  # rows appended to D6 by the run
    metrics: DataFrame       # one row: scraped, in_db, unchanged, new_ads, removed, ...
    joined: DataFrame        # persisted join both outputs read; unpersist when done


def lifecycle_step(listed_prev: DataFrame, today_ads: DataFrame, run_date,
                   track_price: bool = False, persist: bool = True,
                   unparsed: DataFrame | None = None, counted: Observation | None = None) -> StepResult:
    """One run of the lifecycle as a pure function of (open ads before
    the run, today's clean ads, run date).

    * new ads (J2) are inserted with ``days_listed = datediff(run, pub)``;
    * removed ads (J3) leave with their stored ``days_listed`` and
      ``removed_date = run_date``;
    * still-listed ads (J5) keep their stored attributes (Q19) and get
      ``days_listed = greatest(stored, datediff(run, list_date))`` (J6);
    * duplicate keys today: the last by (pub_date, url) wins (W3), but the
      metrics count every row, as the reference does;
    * ``unparsed`` (``url_hash`` of today's records that could not be parsed):
      an open ad among them is still listed and keeps its stored row, its
      rows count as unchanged; one that is not open is not inserted.

    ``counted``: an observation that gets the metrics (but for the run date)
    from the first write of ``listed_next``, so that they need no job.
    """
    run = X.run_date_lit(run_date)
    today_rows = today_ads.select(*listed_row_from_ad(run), F.col("url"))
    value = F.struct(*[c for c in LISTED_COLS if c != "url_hash"])
    # total order (the value itself breaks ties) so a recomputation picks the same row
    last = F.max_by(value, F.struct(F.col("list_date"), F.col("url"), value))
    if unparsed is not None:   # rows without values: max_by skips their null order
        blank = unparsed.where(F.col("url_hash").isNotNull()).select("url_hash")
        today_rows = today_rows.unionByName(blank, allowMissingColumns=True)
        parsed = F.col("url").isNotNull()
        last = F.max_by(F.when(parsed, value), F.when(parsed, F.struct(F.col("list_date"), F.col("url"), value)))
    t = (today_rows.groupBy("url_hash")
         .agg(last.alias("t"), F.count("url").alias("n_parsed"), F.count(F.lit(1)).alias("n_today")))
    p = listed_prev.select("url_hash", F.struct(*[c for c in LISTED_COLS if c != "url_hash"]).alias("p"))
    joined = t.join(p, "url_hash", "full_outer")
    if persist:   # several outputs read it; a single-output caller passes False
        joined = joined.persist()

    in_t, in_p, seen = F.col("t").isNotNull(), F.col("p").isNotNull(), F.col("n_today").isNotNull()
    refreshed = F.greatest(F.col("p.days_listed"), F.datediff(run, F.col("p.list_date")))
    tracked = ("price", "sqm_price") if track_price else ()

    def pick(c):
        # still-listed ads keep stored attributes (Q19) unless price is tracked
        if c == "days_listed":
            return F.when(in_p, refreshed).otherwise(F.col("t.days_listed")).cast("int").alias(c)
        if c in tracked:
            return F.when(in_t, F.col(f"t.{c}")).otherwise(F.col(f"p.{c}")).alias(c)
        return F.when(in_p, F.col(f"p.{c}")).otherwise(F.col(f"t.{c}")).alias(c)

    unchanged = F.coalesce(F.sum(F.when(in_p, F.col("n_today"))), F.lit(0)).cast("bigint")
    new_ads = F.coalesce(F.sum(F.when(~in_p, F.col("n_parsed"))), F.lit(0)).cast("bigint")
    counts = [
        (unchanged + new_ads).alias("scraped"), F.count_if(in_p).alias("in_db"),
        unchanged.alias("unchanged"), new_ads.alias("new_ads"),
        F.count_if(in_p & ~seen).alias("removed"),
        F.count_if(in_t | (seen & in_p)).alias("active_total"),
        F.count_if(in_p & ~seen & (F.col("p.price") < PRICE_CAP)).alias("removed_under_cap_delta")]
    every = joined.observe(counted, *counts) if counted is not None else joined
    listed_next = every.where(in_t | (seen & in_p)).select("url_hash", *[pick(c) for c in LISTED_COLS if c != "url_hash"])
    removed_delta = joined.where(in_p & ~seen).select(
        "url_hash", *[F.col(f"p.{c}").alias(c) for c in
                      ["room_count", "house_floors", "apt_floor", "price", "sqm", "sqm_price", "apt_address"]],
        F.col("p.list_date").alias("listed_date"), run.alias("removed_date"),
        F.col("p.days_listed").alias("days_listed"), F.col("p.view_count").alias("view_count"))
    metrics = joined.agg(*counts).select(run.alias("run_date"), "*")
    return StepResult(listed_next, removed_delta, metrics, joined)


# --- multi-day forms: all consecutive snapshot pairs, W4 backfill ----------------

def snapshot_days(snapshots: DataFrame, day: str = "run_date") -> DataFrame:
    """Distinct snapshot days with their index and the next snapshot day.
    One row per day: the only unpartitioned window, pinned and small."""
    w = Window.orderBy("day")
    days = (snapshots.select(F.col(day).alias("day")).distinct()
            .select("day", F.row_number().over(w).alias("day_idx"), F.lead("day").over(w).alias("next_day")))
    return pin(days)


def _indexed(snapshots: DataFrame, key: str, day: str) -> tuple[DataFrame, DataFrame]:
    days = snapshot_days(snapshots, day)
    s = snapshots.select(F.col(key).alias("k"), F.col(day).alias("day")).distinct()
    return s.join(bounded_broadcast(days), "day"), days


def daily_status(snapshots: DataFrame, key: str = "ad_key", day: str = "run_date") -> DataFrame:
    """J1 for every consecutive pair of snapshots at once:
    (key, run_date, status). The first snapshot's ads are all new; an ad
    missing from the next snapshot is 'removed' on that next day."""
    s, days = _indexed(snapshots, key, day)
    w = Window.partitionBy("k").orderBy("day_idx")
    marked = s.select("k", "day", "day_idx", "next_day",
                      F.lag("day_idx").over(w).alias("prev_idx"),
                      F.lead("day_idx").over(w).alias("next_idx"))
    here = F.struct(F.col("day").alias("run_date"),
                    F.when(F.col("prev_idx") == F.col("day_idx") - 1, F.lit(STILL)).otherwise(F.lit(NEW)).alias("status"))
    gone = F.struct(F.col("next_day").alias("run_date"), F.lit(REMOVED).alias("status"))
    leaves = F.col("next_day").isNotNull() & (F.col("next_idx").isNull() | (F.col("next_idx") != F.col("day_idx") + 1))
    rows = F.when(leaves, F.array(here, gone)).otherwise(F.array(here))
    return (marked.select(F.col("k").alias(key), F.explode(rows).alias("r"))
            .select(key, "r.run_date", "r.status"))


def run_metrics_from_status(status: DataFrame, key: str = "ad_key") -> DataFrame:
    """A12 + R5 over all runs: one row per run date, with running totals.
    The running sum is a window over the per-day rows only."""
    per_day = status.groupBy("run_date").agg(
        F.count_if(F.col("status") != REMOVED).alias("scraped"),
        F.count_if(F.col("status") != NEW).alias("in_db"),
        F.count_if(F.col("status") == STILL).alias("unchanged"),
        F.count_if(F.col("status") == NEW).alias("new_ads"),
        F.count_if(F.col("status") == REMOVED).alias("removed"))
    w = Window.orderBy("run_date").rowsBetween(Window.unboundedPreceding, 0)
    return per_day.select("*", (F.col("scraped")).alias("active_total"),
                          F.sum("removed").over(w).cast("bigint").alias("removed_total"))


def lifecycle_backfill(snapshots: DataFrame, key: str = "ad_key", day: str = "run_date",
                       list_date: str | None = None, attrs: list[str] | None = None,
                       order: list[str] | None = None) -> DataFrame:
    """The result of applying J4 to every snapshot day in order, in one
    job (gaps and islands). One row per listing period:
    (key, list_date, removed_date or NULL when still open, days_listed, attrs).

    An island is a run of consecutive snapshot days; ``list_date`` is the
    island's first day, or the given column's value on that day (the ad's
    publication date, Q20); attributes are those of the first day (Q19).
    """
    attrs = attrs or []
    days = snapshot_days(snapshots, day)
    carry = ([list_date] if list_date else []) + attrs
    base = snapshots.select(F.col(key).alias("k"), F.col(day).alias("day"), *carry)
    if carry:
        # one row per (ad, day), chosen deterministically (the largest by
        # ``order``, default the carried columns) so a recomputation after an
        # executor loss picks the same row; an aggregate, combined map-side
        value = F.struct(*carry)
        pick = F.max_by(value, F.struct(*[F.col(c) for c in (order or carry)], value))
        s = base.groupBy("k", "day").agg(pick.alias("_c")).select("k", "day", *[F.col("_c." + c).alias(c) for c in carry])
    else:
        s = base.distinct()
    s = s.join(bounded_broadcast(days.select("day", "day_idx")), "day")
    w = Window.partitionBy("k").orderBy("day_idx")
    g = s.withColumn("grp", F.col("day_idx") - F.row_number().over(w))
    first = F.min_by(F.struct("day", *carry), F.col("day_idx"))
    isl = g.groupBy("k", "grp").agg(first.alias("f"), F.max("day_idx").alias("last_idx"),
                                    F.max("day").alias("last_day"))
    nxt = bounded_broadcast(days.select(F.col("day_idx").alias("last_idx"), F.col("next_day").alias("removed_date")))
    out = isl.join(nxt, "last_idx")
    ld = F.col("f." + list_date) if list_date else F.col("f.day")
    return out.select(F.col("k").alias(key), ld.alias("list_date"), "removed_date",
                      F.datediff(F.col("last_day"), ld).cast("int").alias("days_listed"),
                      *[F.col("f." + a).alias(a) for a in attrs])
