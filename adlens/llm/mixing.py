"""Mixing sources to target weights by entropy balancing.

Sources in code-point order (null last) take the weights in turn; targets
share the whole by weight, are cut at ``max_rate`` times the source's size,
and the excess goes to the others until none is above its limit.

Each document of a source gets the rate ``min(max_rate, exp(tilt * size /
longest size))``; the tilt of each source solves the dual of entropy
balancing, "rates times sizes add up to the target". All sources iterate
together: a Newton step is one aggregation over the histogram
(source, size, documents), kept inside a bracket by bisection.

Rates then become whole copies. Documents of one source and size share a rate,
so copies are dealt per histogram row, longest first, with what rounding
leaves over carried on to the next shorter size. Within a histogram row the
documents with the smallest hashes of (doc_id) take the extra copy.

Sizes of one task: the histogram of a source has at most sqrt(2 * words)
rows, since its sizes differ; documents themselves are never grouped.

Defined cases: a null or blank text has size 0 and is taken never; null is a
source; an empty table gives an empty mix; repeated rows of one doc_id share
one decision; extra columns are kept by ``mix`` and ignored by ``plan_mix``.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import rank_within
from ..operators.sizing import bounded_broadcast, pin, spread

WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
MAX_RATE = 3
# Histogram rows up to which the copies are broadcast to the documents.
BROADCAST_ROWS = 200_000


def word_count(text: str = "text"):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights=WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """``source``, ``source_size``, ``longest``, ``target`` from rows of
    ``source`` and ``size``. The windows hold one row per source."""
    every = Window.partitionBy()
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.max("size").alias("longest"))
    place = F.row_number().over(every.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("most", F.col("source_size") * float(max_rate))
    # the level of the water: sources whose limit lies below it are full
    up = every.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    after = up.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(every)
    level = (total - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    per = per.withColumn("_level", level)
    per = per.withColumn("_level", F.max(F.when(F.col("most") / F.col("weight") >= F.col("_level"), F.col("_level"))).over(every))
    target = F.least(F.col("most"), F.coalesce(F.col("_level") * F.col("weight"), F.col("most")))
    return per.select("source", "source_size", "longest", target.alias("target"))


def solve_tilts(histogram: DataFrame, per_source: DataFrame, max_rate: int = MAX_RATE,
                tolerance: float = 1e-4, max_steps: int = 60) -> DataFrame:
    """``source`` and ``tilt``. ``histogram`` has source, size (above 0), n.
    Steps that leave the bracket are halvings, so some dozens always do; a
    source that is not within the tolerance after ``max_steps`` is an error."""
    x = F.col("size") / F.col("longest")
    start = histogram.groupBy("source").agg(F.min("size").alias("shortest"))
    top, share = F.lit(math.log(max_rate)), F.col("target") / F.col("source_size")
    reach = F.col("longest") / F.col("shortest")
    state = pin(per_source.where("source_size > 0").join(start, per_source["source"].eqNullSafe(start["source"]))
                .select(per_source["source"], "source_size", "longest", "target",
                        F.least(F.lit(0.0), F.log(share) * reach).alias("low"), (top * reach).alias("high"),
                        F.when(share >= max_rate, top * reach).otherwise(F.lit(0.0)).alias("tilt")))
    for _ in range(max_steps):
        rate = F.exp(F.least(F.col("tilt") * x, top))
        words = F.col("n") * F.col("size") * rate
        sums = (histogram.alias("h").join(bounded_broadcast(state, BROADCAST_ROWS).alias("s"), F.expr("h.source <=> s.source"))
                .groupBy("s.source").agg(
                    F.sum(words).alias("_got"),
                    F.sum(F.when(F.col("tilt") * x < top, words * x).otherwise(0.0)).alias("_slope")))
        gap = F.col("target") - F.col("_got")
        low = F.when(gap > 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("high")).otherwise(F.col("tilt"))
        newton = F.col("tilt") + F.try_divide(gap, F.col("_slope"))
        step = F.when((newton > low) & (newton < high), newton).otherwise((low + high) / 2)
        near = F.abs(gap) <= F.col("target") * tolerance
        state = pin(state.alias("s").join(sums.alias("g"), F.expr("s.source <=> g.source"))
                    .select("s.source", "source_size", "longest", "target", low.alias("low"), high.alias("high"),
                            F.when(near, F.col("tilt")).otherwise(step).alias("tilt"), near.alias("near")))
        if state.where("not near").limit(1).count() == 0:
            return state.select("source", "tilt")
        state = state.drop("near")
    raise ArithmeticError(f"the tilts are not within {tolerance} of their targets after {max_steps} steps")


def _deal(cells: pd.DataFrame) -> pd.DataFrame:
    """Copies of every histogram row of one source, longest size first."""
    cells = cells.sort_values("size", ascending=False)
    copies, left = np.zeros(len(cells), np.int64), 0.0
    for i, (size, n, rate, most) in enumerate(zip(cells["size"], cells["n"], cells["rate"], cells["most"])):
        want = n * rate * size + left
        copies[i] = min(max(math.floor(want / size + 0.5), 0), n * most)
        left = want - float(copies[i]) * size
    return pd.DataFrame({"source": cells["source"], "size": cells["size"], "n": cells["n"], "copies": copies})


def plan_mix(docs: DataFrame, weights=WEIGHTS, max_rate: int = MAX_RATE):
    """(sizes, per_source, cells): each document's doc_id, source and size;
    the targets; and per (source, size) the copies every document takes
    (``base``) with the largest (hash, doc_id) that takes one more."""
    id_type = docs.schema["doc_id"].dataType
    sizes = pin(spread(docs.select("doc_id", "source", "text")).select("doc_id", "source", word_count().alias("size")))
    per_source = pin(targets(sizes, weights, max_rate))
    histogram = pin(sizes.where("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    tilts = solve_tilts(histogram, per_source, max_rate)
    rate = F.exp(F.least(F.col("tilt") * F.col("size") / F.col("longest"), F.lit(math.log(max_rate))))
    rated = (histogram.alias("h").join(per_source.alias("p"), F.expr("h.source <=> p.source"))
             .join(tilts.alias("t"), F.expr("h.source <=> t.source"))
             .select("h.source", "h.size", "h.n", rate.alias("rate"), F.lit(max_rate).alias("most")))
    dealt = pin(rated.groupBy("source").applyInPandas(_deal, "source string, size bigint, n bigint, copies bigint")
                .withColumn("base", F.floor(F.col("copies") / F.col("n"))).withColumn("extra", F.col("copies") % F.col("n")))
    # the rank only of documents in rows that deal some, not all, one copy more
    some = bounded_broadcast(dealt.where("extra > 0"), BROADCAST_ROWS).alias("c")
    chance = sizes.alias("d").join(some, F.expr("d.source <=> c.source and d.size = c.size")).select(
        "d.source", "d.size", "c.extra", _hash("d.doc_id").alias("hash"), "d.doc_id")
    ranked = rank_within(chance, ["source", "size"], ["hash", "doc_id"], "rank")
    last = ranked.where("rank = extra").select("source", "size", F.col("hash").alias("last_hash"),
                                               F.col("doc_id").cast(id_type).alias("last_id"))
    cells = pin(dealt.alias("c").join(last.alias("l"), F.expr("c.source <=> l.source and c.size = l.size"), "left")
                .select("c.source", "c.size", "c.base", "l.last_hash", "l.last_id"))
    return sizes, per_source, cells


def _hash(doc_id: str):
    return F.xxhash64(F.col(doc_id).cast("string"), F.lit("mix"))


def with_copies(rows: DataFrame, cells: DataFrame, name: str) -> DataFrame:
    """Add the copies of each row of doc_id, source and size."""
    more = (_hash("d.doc_id") < F.col("c.last_hash")) | (
        (_hash("d.doc_id") == F.col("c.last_hash")) & F.coalesce(F.col("d.doc_id") <= F.col("c.last_id"), F.lit(True)))
    copies = F.coalesce(F.col("c.base") + F.coalesce(more, F.lit(False)).cast("bigint"), F.lit(0)).cast("bigint")
    return (rows.alias("d").join(bounded_broadcast(cells, BROADCAST_ROWS).alias("c"),
                                 F.expr("d.source <=> c.source and d.size = c.size"), "left")
            .select("d.*", copies.alias(name)))


def allocation(docs: DataFrame, weights=WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target`` and ``taken`` words."""
    sizes, per_source, cells = plan_mix(docs, weights, max_rate)
    dealt = with_copies(sizes, cells, "copies")
    return dealt.alias("d").join(bounded_broadcast(per_source, BROADCAST_ROWS).alias("p"), F.expr("d.source <=> p.source")).select(
        "d.doc_id", "d.size", "p.source_size", "p.target", (F.col("d.copies") * F.col("d.size")).alias("taken"))


def mix(docs: DataFrame, weights=WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as it is taken."""
    _, _, cells = plan_mix(docs, weights, max_rate)
    names = docs.columns
    rows = spread(docs).select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), "doc_id", "source",
                               word_count().alias("size"))
    taken = with_copies(rows, cells, "copies").where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
