"""Exact top-k inner products by columnar branch and bound.

Vectors become integers, floor(scale * x). A task holds a block of candidates
in vertical layout (one array per dimension) and works through one block of
queries: inner products grow dimension block by dimension block, dimensions of
the largest spread first and blocks halving in size. After every block the mass that is left, the product
of both norms over the remaining dimensions, bounds what a candidate can still
reach; candidates below the query's k-th best score are dropped and the
survivors compacted. The first candidates of a task are scored in full, which
sets that score. Bounds are widened by more than the rounding of the float
arithmetic, products of such integers are exact, so no result is lost.

Queries come in rounds of at most ``round_queries`` rows, each broadcast to
all tasks; tasks return their k best per query, which Spark merges.

Defined cases: vectors that are null, empty of components, or hold null or
non-finite components take no part, nor do rows without a vec_id and vectors
of another length than most; rows that share a vec_id count as one another's
own row; ties go to the smaller vec_id; with fewer than k candidates all are
returned; without queries the result is empty. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.sizing import pin, spread
from .spans import batches

ROUND_QUERIES = 20_000
QUERY_BLOCK = 512
CANDIDATE_BLOCK = 1024
# Share of a tile's pairs below which survivors are compacted, and how many of
# these are handled at a time.
FEW = 0.05
SURVIVORS = 1 << 15


def integer_vectors(rows: DataFrame, scale: float = 64.0) -> DataFrame:
    """``vec_id`` and ``v``, the integers of each usable vector, bounded to
    +-2^53. Rows without a vec_id take no part, neither as queries nor as
    candidates."""
    limit = float(1 << 53)
    bounded = lambda x: F.greatest(F.least(F.lit(scale) * x.cast("double"), F.lit(limit)), F.lit(-limit))
    whole = F.transform("embedding", lambda x: F.floor(bounded(x)).cast("bigint"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return rows.where("vec_id is not null and embedding is not null and size(embedding) > 0").where(~bad).select(
        "vec_id", whole.alias("v"))


def _matrix(column) -> np.ndarray:
    """Float64 rows of an Arrow list column; integers stay exact."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


class _Best:
    """The k best (score, smaller id) of each query of a block."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.scores = np.full((n, k), -np.inf)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)

    def limit(self) -> np.ndarray:
        return self.scores[:, -1]

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Merge (query, score, id) triples."""
        touched, place = np.unique(query, return_inverse=True)
        q = np.concatenate([np.repeat(np.arange(len(touched)), self.k), place])
        s = np.concatenate([self.scores[touched].ravel(), score])
        i = np.concatenate([self.ids[touched].ravel(), ids])
        order = np.lexsort((i, -s, q))
        q, s, i = q[order], s[order], i[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        keep = rank < self.k
        self.scores[touched], self.ids[touched] = s[keep].reshape(-1, self.k), i[keep].reshape(-1, self.k)


def search_block(best: _Best, q_ids, q, tail_q, c_ids, c, order, cuts) -> None:
    """All candidates ``c`` (rows) against all queries ``q`` of a block."""
    columns = c.T[order]  # vertical layout
    own = q_ids[:, None] == c_ids[None, :]
    if not np.isfinite(best.limit()).all():  # no limit yet: score in full
        score = q[:, order] @ columns
        score[own] = -np.inf
        k = min(best.k, len(c_ids))
        floor = np.partition(score, -k, axis=1)[:, -k]
        query, cand = np.nonzero((score >= floor[:, None]) & (score > -np.inf))
        best.add(query, score[query, cand], c_ids[cand])
        return
    square = np.cumsum(columns[::-1] ** 2, axis=0)[::-1]
    left = lambda cut: np.sqrt(square[cut]) if cut < len(order) else np.zeros(len(c))
    limit = best.limit()
    part, i = np.zeros((len(q_ids), len(c_ids))), 0
    while True:  # all pairs, until few can still reach the limit
        part += q[:, order[cuts[i]:cuts[i + 1]]] @ columns[cuts[i]:cuts[i + 1]]
        i += 1
        alive = part + (tail_q[i][:, None] * 1.000001) * left(cuts[i])[None, :] >= limit[:, None] - 1e-6
        if i == len(cuts) - 1 or np.count_nonzero(alive) < FEW * alive.size:
            break
    all_query, all_cand = np.nonzero(alive & ~own)
    for s in range(0, len(all_query), SURVIVORS):
        query, cand = all_query[s:s + SURVIVORS], all_cand[s:s + SURVIVORS]
        score = part[query, cand]
        for j in range(i, len(cuts) - 1):
            for d in range(cuts[j], cuts[j + 1]):
                score = score + q[query, order[d]] * columns[d][cand]
            ok = score + tail_q[j + 1][query] * left(cuts[j + 1])[cand] * 1.000001 + 1e-6 >= best.limit()[query]
            query, cand, score = query[ok], cand[ok], score[ok]
        if len(query):
            best.add(query, score, c_ids[cand])


def dimension_cuts(n: int) -> list[int]:
    """Bounds of the dimension blocks: half of what is left, at least eight."""
    cuts = [0]
    while cuts[-1] < n:
        cuts.append(min(n, cuts[-1] + max(8, (n - cuts[-1]) // 2)))
    return cuts


def top_k(queries: DataFrame, candidates: DataFrame, k: int, round_queries: int = ROUND_QUERIES) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` for each query id; both
    inputs are ``integer_vectors``. Of rows that repeat a query's id the least
    vector asks; as candidates all rows count. Vectors of another length than
    most candidates (of equally frequent ones, the longest) take no part.
    Scores are exact below 2^53."""
    spark = queries.sparkSession
    queries, candidates = pin(queries.groupBy("vec_id").agg(F.min("v").alias("v"))), pin(spread(candidates))
    sizes = candidates.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(2).collect()
    if sizes:
        queries = queries.where(F.size("v") == sizes[0]["d"])
    if len(sizes) > 1:
        candidates = candidates.where(F.size("v") == sizes[0]["d"])
    rounds = max(1, -(-queries.count() // round_queries))
    place = F.pmod(F.xxhash64(F.col("vec_id"), F.lit("round")), F.lit(rounds))
    found = None
    for r in range(rounds):
        asked = queries.where(place == r).toArrow()
        part = _one_round(candidates, spark.sparkContext.broadcast(_query_blocks(asked)), k)
        found = part if found is None else found.unionByName(part)
    flat = found.select("query_id", F.explode(F.arrays_zip("vec_id", "score")).alias("x")).select("query_id", "x.vec_id", "x.score")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return flat.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _query_blocks(table: pa.Table):
    if table.num_rows == 0:
        return []
    ids, q = table.column("vec_id").to_numpy(), _matrix(table.column("v").combine_chunks())
    near = np.argsort(q[:, np.argmax(q.var(axis=0))], kind="stable")
    return [(ids[near[i:i + QUERY_BLOCK]], q[near[i:i + QUERY_BLOCK]]) for i in range(0, len(ids), QUERY_BLOCK)]


def _one_round(candidates: DataFrame, shared, k: int) -> DataFrame:
    def run(parts):
        state = []
        for part in batches(parts):
            all_ids, all_c = part.column("vec_id").to_numpy(), _matrix(part.column("v"))
            if not state:
                order = np.argsort(-all_c.var(axis=0), kind="stable")
                cuts = dimension_cuts(len(order))
                for ids, q in shared.value:
                    left = np.cumsum((q[:, order] ** 2)[:, ::-1], axis=1)[:, ::-1]
                    tails = [np.sqrt(left[:, c]) if c < len(order) else np.zeros(len(ids)) for c in cuts]
                    state.append((ids, q, tails, _Best(len(ids), k)))
            for a in range(0, len(all_ids), CANDIDATE_BLOCK):
                ids, c = all_ids[a:a + CANDIDATE_BLOCK], all_c[a:a + CANDIDATE_BLOCK]
                for q_ids, q, tails, best in state:
                    search_block(best, q_ids, q, tails, ids, c, order, cuts)
        for q_ids, _, _, best in state:
            real = best.scores > -np.inf
            rows = np.flatnonzero(real.any(axis=1))
            if len(rows) == 0:
                continue
            off = pa.array(np.concatenate([[0], np.cumsum(real[rows].sum(axis=1))]), pa.int32())
            flat = real[rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array(q_ids[rows]), pa.ListArray.from_arrays(off, pa.array(best.ids[rows][flat])),
                 pa.ListArray.from_arrays(off, pa.array(np.clip(best.scores[rows][flat], -9.2e18, 9.2e18).astype(np.int64)))],
                ["query_id", "vec_id", "score"])

    return candidates.mapInArrow(run, "query_id bigint, vec_id array<bigint>, score array<bigint>")
