"""Mergeable daily aggregate states.

Statistics over a range of dates are usually a scan of all ads in it. Here
every (date, segment) leaves one small state: count, sum, least and largest
value, and Spark's own sketches for quantiles (KLL) and distinct values (HLL).
States of any dates merge into the state of the range, so a report over years
reads a row per date and segment instead of the ads. Count, sum, minimum,
maximum and the average are exact; a quantile's rank and a distinct count are
within the sketches' error.

Layout: ``root/month=YYYY-MM``, the days of a month together, so that a range
reads only its months. Writing dates replaces these dates and keeps the others.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.writers import write_dated
from .sizing import pin

#: Size of the quantile sketches; the rank of a quantile is off by less than 1 % (99 % of the time).
QUANTILE_K = 400
#: log2 of the distinct sketches' size; an estimate is off by about 1.6 % (one sigma).
DISTINCT_K = 12
MONEY = "decimal(18,2)"
MEASURES = ["n", "total", "low", "high", "values", "sizes", "others"]


def daily_states(ads: DataFrame, day: str, segment: str, price: str, size: str | None = None, other: str | None = None) -> DataFrame:
    """One state per (day, segment). ``size``: a second measure, of which only
    quantiles are kept; ``other``: a column whose distinct values are counted.
    Aggregates only, combined map-side."""
    p = F.col(price).cast(MONEY)
    none = F.lit(None).cast("binary")
    return ads.groupBy(F.col(day).cast("date").alias("day"), F.col(segment).cast("string").alias("segment")).agg(
        F.count(p).alias("n"), F.sum(p).cast("decimal(38,2)").alias("total"), F.min(p).alias("low"), F.max(p).alias("high"),
        F.kll_sketch_agg_double(p.cast("double"), QUANTILE_K).alias("values"),
        (F.kll_sketch_agg_double(F.col(size).cast("double"), QUANTILE_K) if size else F.first(none)).alias("sizes"),
        (F.hll_sketch_agg(F.col(other).cast("string"), DISTINCT_K) if other else F.first(none)).alias("others"))


_SCHEMA = ("day date, segment string, n bigint, total decimal(38,2), low decimal(18,2), high decimal(18,2), "
           "values binary, sizes binary, others binary, month string")
_COLUMNS = ["day", "segment", *MEASURES, "month"]


def read_states(spark: SparkSession, root: str, first=None, last=None) -> DataFrame:
    """The states of the days from ``first`` to ``last``, months pruned."""
    try:
        states = spark.read.schema(_SCHEMA).parquet(root)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _SCHEMA)
    for bound, inside in ((first, lambda c, b: c >= b), (last, lambda c, b: c <= b)):
        if bound is not None:
            d = F.lit(bound).cast("date")
            states = states.where(inside(F.col("month"), F.date_format(d, "yyyy-MM")) & inside(F.col("day"), d))
    return states


def write_states(states: DataFrame, root: str) -> None:
    """Put the states of their days in place; other days stay."""
    spark = states.sparkSession
    new = pin(states.where("day is not null").withColumn("month", F.date_format("day", "yyyy-MM")).select(_COLUMNS))
    days, months = new.select("day").distinct(), new.select("month").distinct()
    old = read_states(spark, root).join(months, "month", "left_semi").join(days, "day", "left_anti").select(_COLUMNS)
    write_dated(pin(old.unionByName(new)), root, "month")


def merged(states: DataFrame, by: list[str | Column] = ("segment",)) -> DataFrame:
    """States of all days put together, per segment or any other grouping of
    ``day`` and ``segment``."""
    return states.groupBy(*by).agg(
        F.sum("n").cast("bigint").alias("n"), F.sum("total").cast("decimal(38,2)").alias("total"), F.min("low").alias("low"),
        F.max("high").alias("high"), F.kll_merge_agg_double("values", QUANTILE_K).alias("values"),
        F.kll_merge_agg_double("sizes", QUANTILE_K).alias("sizes"), F.hll_union_agg("others").alias("others"))


def price_stats(state: DataFrame, by: list[str] = ("segment",)) -> DataFrame:
    """A1/A10 from merged states, exact: as ``stats.price_stats``."""
    return state.select(*by, F.col("n").alias("ad_count"), F.col("low").alias("min_price"), F.col("high").alias("max_price"),
                        (F.col("high") - F.col("low")).cast(MONEY).alias("price_range"),
                        F.round(F.col("total") / F.col("n"), 2).cast(MONEY).alias("avg_price"))


def quantiles(state: DataFrame, ranks: list[float], measure: str = "values", by: list[str] = ("segment",)) -> DataFrame:
    """Approximate quantiles of a measure, one array per group; NULL for a
    group without values."""
    got = F.kll_sketch_get_quantile_double(measure, F.array(*[F.lit(float(r)) for r in ranks]))
    return state.select(*by, F.when(F.kll_sketch_get_n_double(measure) > 0, got).alias("quantiles"))


def equi_depth_ranges(state: DataFrame, parts: int, measure: str = "sizes", by: list[str] = ("segment",)) -> DataFrame:
    """``parts`` ranges per group that hold about equally many ads:
    (by, part, from_value, to_value)."""
    bounds = quantiles(state, [i / parts for i in range(parts + 1)], measure, by).where("quantiles is not null")
    cut = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)),
                      lambda i: F.struct(i.alias("part"), F.get("quantiles", i).alias("from_value"), F.get("quantiles", i + 1).alias("to_value")))
    return bounds.select(*by, F.explode(cut).alias("r")).select(*by, "r.part", "r.from_value", "r.to_value")


def distinct_count(state: DataFrame, by: list[str] = ("segment",)) -> DataFrame:
    """Approximate number of distinct values of the counted column."""
    return state.select(*by, F.hll_sketch_estimate("others").alias("distinct_values"))
