"""Open ads on any date from listing periods (S11, K11, X4), without snapshots.

A period [start, end) covers many dates, so "which periods cover this date" is
a range condition, which Spark can only answer by a nested loop. Here every
period is cut into the calendar months it touches, every date belongs to one
month, and the join is an equality on the month with the range as a filter.
A date meets a period in its own month only, so no pair comes twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sizing import bounded_broadcast, pin


def open_on(periods: DataFrame, dates: DataFrame, start: str = "list_date", end: str = "removed_date", day: str = "run_date") -> DataFrame:
    """The periods with every asked date they cover, the date as ``day``
    (start <= date < end; a NULL end is open). Dates are taken once each: there
    are at most as many as the calendar has days, so they are broadcast behind
    their size check and the periods, cut into months, are not shuffled. A
    period is cut no further than the last date asked for."""
    asked = pin(dates.select(F.col(day).cast("date").alias("_day")).where("_day is not null").distinct())
    known = asked.agg(F.min("_day").alias("first"), F.max("_day").alias("last")).first()
    own = periods.drop(*[c for c in (day,) if c not in (start, end)])
    if known["last"] is None:
        return own.where("false").withColumn(day, F.lit(None).cast("date"))
    last = F.least(F.coalesce(F.date_sub(F.col(end), 1), F.lit(known["last"])), F.lit(known["last"]))
    first = F.greatest(F.col(start), F.lit(known["first"]))
    months = F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month"))
    cut = own.where(F.col(start).isNotNull() & (first <= last)).withColumn("_month", F.explode(months))
    days = bounded_broadcast(asked).withColumn("_month", F.trunc("_day", "month"))
    met = cut.join(days, "_month").where((F.col(start) <= F.col("_day")) & (F.col(end).isNull() | (F.col("_day") < F.col(end))))
    return met.drop("_month").withColumnRenamed("_day", day)
