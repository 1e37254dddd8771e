"""Listing periods as keyed event-time state (J4, ST1-ST3 without reruns).

``report_stream`` hands every micro-batch to a state store, which works out
the dates again that a late file touches. Here the open ads themselves are the
state of the stream: one state per ad (``transformWithState``), and one timer
that asks, when the watermark has passed the ad's next run date, whether the
ad was there. Removal is that timer, so nothing rescans the open ads, and a
file may come late by as much as the watermark waits.

State per ad, one value: the records of run dates that are not final yet (by
date), the present stretch of run dates (its last date, the values of its first
parsed record), and the day of the timer set. Each read or write of state and
each timer is a call to the JVM, so an ad reads and writes its state once a
batch, however many dates came, and has one timer, for its next date. A date is final when the watermark has
passed it; then the ad's dates are taken in order: an ``insert`` event leaves
with the first parsed record of a stretch, ``seen`` with a first record that
did not parse, and ``remove`` with the first run date on which the ad is
missing.

Runs are expected every ``every`` days. Days on which no run took place cannot
be told from absence by an ad alone; ``listing_periods`` joins the events with
the calendar of run dates, which mends that: a period that ended on a day
without a run goes on.

Needs Spark's RocksDB state store and, for Python stateful processors, the
``protobuf`` package on driver and executors.
"""

from __future__ import annotations

import contextlib
import datetime as _dt
import json
import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from .. import schemas
from ..operators.changes import INSERT, REMOVE, VALUES
from ..operators.lifecycle import listed_row_from_ad
from ..operators.sizing import bounded_broadcast, pin

SEEN_ONLY = "seen"
DAY_MS = 86_400_000
EPOCH = _dt.date(1970, 1, 1)
_FIELDS = [f for f in schemas.LISTED_ADS.fields if f.name in VALUES]
VALUE = T.StructType(_FIELDS)
_LIST_DATE = 2 + VALUES.index("list_date")      # two columns stand before the values
EVENT = T.StructType([T.StructField("op", T.StringType()), T.StructField("run_date", T.DateType()), T.StructField("url_hash", T.StringType()), *_FIELDS])
# as JSON: PySpark sends the schema with every value, which costs more than the value
STATE = T.StructType([T.StructField("ad", T.StringType())])

# the processor is pickled by value: executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Listings(StatefulProcessor):
    """The state of one ad; days are counted from 1970-01-01."""

    def __init__(self, every: int):
        self.every = every

    def init(self, handle) -> None:
        self.handle = handle
        self.ad = handle.getValueState("ad", STATE)

    def handleInputRows(self, key, rows, timerValues):
        best, now, due = self._read()
        for r in rows:
            day, got = r["day"], (r["parsed"], r["url"], *[r[c] for c in VALUES])
            if day not in best or _order(got) > _order(best[day]):
                best[day] = got
        self._keep(best, now, due)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        """Take all dates before the watermark in order."""
        final = (timerValues.getCurrentWatermarkInMs() - 1) // DAY_MS      # the last final day
        days, now, due = self._read()
        if due is None or due > final:
            return       # a timer set before an earlier one: its dates are done
        while True:
            steps = [d for d in days if d <= final]
            if now is not None and now[1] + self.every <= final:
                steps.append(now[1] + self.every)
            if not steps:
                break
            day = min(steps)
            got = days.pop(day, None)
            if now is not None and (got is None or day > now[1] + self.every):
                yield self._event(REMOVE, now[1] + self.every, key, self._after(now))
                now = None
            if got is None:
                continue
            if got[0] and (now is None or not now[0]):
                now = (True, day, *got[2:])
                yield self._event(INSERT, day, key, got[2:])
            elif now is None:
                now = (False, day, *[None] * len(VALUES))
                yield self._event(SEEN_ONLY, day, key, now[2:])
            else:
                now = (now[0], day, *now[2:])
        self._keep(days, now, None)

    def _read(self):
        """(records by day, the stretch or None, the day of the timer or None)."""
        kept = self.ad.get()
        if kept is None:
            return {}, None, None
        days, now, due = json.loads(kept[0])
        return {d: _from_json(got) for d, *got in days}, _from_json(now) if now else None, due

    def _keep(self, days, now, due) -> None:
        """Write the state, with a timer for the ad's next date unless one as
        early is set."""
        dates = [*days, *([now[1] + self.every] if now is not None else [])]
        if not dates:
            return self.ad.clear()
        if due is None or min(dates) < due:
            due = min(dates)
            self.handle.registerTimer(due * DAY_MS + 1)
        self.ad.update((json.dumps([[[d, *_to_json(got)] for d, got in days.items()], _to_json(now) if now else None, due]),))

    def close(self) -> None:
        pass

    @staticmethod
    def _after(now):
        """The values with the days on the market of the last date."""
        values = dict(zip(VALUES, now[2:]))
        if values["list_date"] is not None:
            on = (_date(now[1]) - values["list_date"]).days
            values["days_listed"] = on if values["days_listed"] is None else max(values["days_listed"], on)
        return tuple(values[c] for c in VALUES)

    @staticmethod
    def _event(op, day, key, values):
        return Row(op=op, run_date=_date(day), url_hash=key[0], **dict(zip(VALUES, values)))


def _date(day: int) -> _dt.date:
    return EPOCH + _dt.timedelta(days=int(day))


def _to_json(got) -> list:
    """Dates as days; both tuples of the state end with the values."""
    on = got[_LIST_DATE]
    return [*got[:_LIST_DATE], None if on is None else (on - EPOCH).days, *got[_LIST_DATE:][1:]]


def _from_json(got) -> tuple:
    on = got[_LIST_DATE]
    return (*got[:_LIST_DATE], None if on is None else _date(on), *got[_LIST_DATE:][1:])


def _order(got) -> tuple:
    """The last record of a date by publication date and address, parsed
    ones before others; nulls first."""
    parsed, url, *values = got
    known = dict(zip(VALUES, values))
    return (parsed, _nulls_first(known["list_date"]), _nulls_first(url), *[_nulls_first(known[c]) for c in VALUES])


def _nulls_first(v) -> tuple:
    return (v is not None, v if v is not None else 0)


def stream_rows(ads: DataFrame) -> DataFrame:
    """Ads of a stream or table (clean columns; ``_reason`` when records that
    did not parse are among them) as the processor's rows."""
    parsed = F.col("_reason").isNull() if "_reason" in ads.columns else F.lit(True)
    rows = ads.where(F.col("url_hash").isNotNull() & F.col("run_date").isNotNull())
    return rows.select(*listed_row_from_ad(F.col("run_date")), "url", parsed.alias("parsed"),
                       F.datediff("run_date", F.lit(EPOCH)).alias("day"), F.col("run_date").cast("timestamp").alias("event_time"))


def listing_events(ads: DataFrame, lateness: str = "2 days", every: int = 1) -> DataFrame:
    """The streaming DataFrame of insert and remove events. ``lateness``: how
    far a run date may come behind the latest one; older records are dropped
    by the watermark (``plans.delta_store.deliver`` takes those)."""
    rows = stream_rows(ads).withWatermark("event_time", lateness)
    return rows.groupBy("url_hash").transformWithState(Listings(every), EVENT, "append", "eventTime")


@contextlib.contextmanager
def rocksdb(spark: SparkSession):
    """The state store that keyed processors need, for streams started inside."""
    before = spark.conf.get(PROVIDER_KEY, None)
    spark.conf.set(PROVIDER_KEY, PROVIDER)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER_KEY)
        else:
            spark.conf.set(PROVIDER_KEY, before)


def start(spark: SparkSession, ads: DataFrame, out: str, checkpoint: str, lateness: str = "2 days", every: int = 1, available_now: bool = True):
    """Write the events of a stream of ads as Parquet under ``out``, each once."""
    with rocksdb(spark):
        writer = (listing_events(ads, lateness, every).writeStream.outputMode("append").format("parquet")
                  .option("path", out).option("checkpointLocation", checkpoint))
        return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 minutes")).start()


def run_calendar(run_dates: DataFrame) -> DataFrame:
    """For every day from the first to the last run date the first run date
    that is not before it: (day, next_run). A row per day."""
    runs = run_dates.select(F.col("run_date").alias("run")).where("run is not null").distinct()
    span = runs.agg(F.explode(F.sequence(F.min("run"), F.max("run"))).alias("day"))
    later = Window.orderBy("day").rowsBetween(0, Window.unboundedFollowing)
    return pin(span.join(runs, F.col("day") == F.col("run"), "left").select("day", F.min("run").over(later).alias("next_run")))


def listing_periods(events: DataFrame, run_dates: DataFrame, every: int = 1) -> DataFrame:
    """Listing periods from the events and the run dates that took place:
    url_hash, first_date, the values, removed_date (NULL while open) and
    days_listed. The values are those of the first parsed date (Q19)."""
    calendar = bounded_broadcast(run_calendar(run_dates))
    last = run_dates.agg(F.max("run_date").alias("last_run"))
    ad = Window.partitionBy("url_hash").orderBy("run_date")
    marks = events.join(calendar, F.col("run_date") == F.col("day"), "left").withColumn("_next", F.lead("run_date").over(ad))
    # a removal counts on the next run date; beyond the last run, and when the
    # ad is back on that very date, the ad was never gone
    gone = (F.col("op") == REMOVE) & F.col("next_run").isNotNull() & (F.col("_next").isNull() | (F.col("next_run") < F.col("_next")))
    upto = ad.rowsBetween(Window.unboundedPreceding, -1)
    marks = marks.withColumn("_gone", gone).withColumn("n", F.coalesce(F.sum(F.col("_gone").cast("int")).over(upto), F.lit(0)))
    first = F.min_by(F.struct("run_date", *VALUES), F.when(F.col("op") == INSERT, F.col("run_date")))
    periods = marks.groupBy("url_hash", "n").agg(
        first.alias("f"), F.max(F.when(F.col("_gone"), F.col("next_run"))).alias("removed_date"),
        F.date_sub(F.max(F.when(F.col("_gone"), F.col("run_date"))), every).alias("_seen"))
    until = F.coalesce(F.col("_seen"), F.col("last_run"))
    return (periods.where(F.col("f").isNotNull()).crossJoin(last)      # one row
            .select("url_hash", F.col("f.run_date").alias("first_date"),
                    *[F.col("f." + c).alias(c) for c in VALUES if c != "days_listed"], "removed_date",
                    F.greatest(F.col("f.days_listed"), F.datediff(until, F.col("f.list_date"))).cast("int").alias("days_listed")))
