"""Whitening of embeddings onto their leading principal components, found by
Chebyshev-filtered subspace iteration.

The covariance is never formed. A block of vectors Q is multiplied by it in
one pass over the table: every task centres its rows, computes Xᵀ(XQ) for
them, and the tasks' partial products (dimensions by block columns, whatever
the number of rows) are added up. A filter step is a Chebyshev recurrence of
such passes that damps the interval of unwanted eigenvalues; then the driver
orthonormalises the block by QR and rotates it to the Ritz vectors of the small
projected matrix (Rayleigh-Ritz). The unwanted interval ends at the block's
smallest Ritz value, which is taken anew in every round. Pairs whose residual
is certified to be at rounding level are held and projected out; the rounds end
when all wanted ones are.

Numbers: components become integers x = floor(64 c) + 1000000, bounded to
+-2^53. Sums are exact integers; rows are centred by the integer part of the
mean first, then by its fraction, so centred rows are exact to rounding.

Odd input: a vector that is null, empty or holds a null or non-finite
component takes no part; so do vectors of another length than the most frequent
one (of equally frequent ones, the longest). Directions without variance are
no components, so fewer than asked may come back, and none from equal rows.
Null and repeated ids are rows like others. A squared deviation that does not
fit a long is null.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.sizing import pin, spread

#: Block columns beyond the wanted ones; they carry the next eigenvalues, which
#: widens the gap between what is kept and what is damped.
GUARD = 16
#: Highest degree of the filter polynomial, so passes per round.
MAX_DEGREE = 30
#: How much more than the last wanted eigenvalue the first may be raised.
SPAN = 1e8
#: A pair is certified when its residual is below this part of the largest
#: eigenvalue; 2^-44 is some hundred roundings.
CERTIFIED = 2.0 ** -44
#: Rounds after which an uncertified run is an error, never a result.
MAX_ROUNDS = 200
#: Directions with less than this part of the total variance count as without.
FLAT = 1e-13
#: Partial products that the driver adds up itself; more are added in tasks first.
FAN_IN = 64
LIMIT = 1 << 53
ROWS = 4096


def integer_component(c: Column) -> Column:
    """floor(64 c) + 1000000 as a long, bounded to +-2^53 before the shift."""
    scaled = F.floor(F.greatest(F.least(c.cast("double") * 64, F.lit(float(LIMIT))), F.lit(-float(LIMIT))))
    return scaled.cast("bigint") + 1_000_000


def integer_rows(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x): the vectors that take part, as arrays of longs."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf"))
    whole = F.coalesce(F.forall("embedding", finite), F.lit(False)) & (F.size("embedding") > 0)
    rows = pin(spread(embeddings.select("vec_id", "embedding")).where(whole).select(
        "vec_id", F.transform("embedding", integer_component).alias("x")))
    common = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return rows.where(F.size("x") == common[0]["d"]) if common else rows


def _matrix(column) -> np.ndarray:
    """The arrays of a record batch's column as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


class Rows:
    """The fit list: n, exact sums per dimension, and passes over it."""

    def __init__(self, vectors: DataFrame):
        self.vectors = vectors
        self.parts = max(1, vectors.rdd.getNumPartitions())

        def sums(batches):
            n, high, low = 0, 0, 0
            for batch in batches:
                x = _matrix(batch.column("x"))
                if len(x):
                    n, high, low = n + len(x), high + (x >> 26).sum(axis=0), low + (x & ((1 << 26) - 1)).sum(axis=0)
            if n:
                yield pa.RecordBatch.from_pydict({"i": np.arange(len(high)), "n": np.full(len(high), n), "high": high, "low": low})

        wide = "decimal(38,0)"
        got = (vectors.select("x").mapInArrow(sums, "i bigint, n bigint, high bigint, low bigint").groupBy("i")
               .agg(F.sum("n").alias("n"), F.sum(F.col("high").cast(wide)).alias("high"), F.sum(F.col("low").cast(wide)).alias("low"))
               .orderBy("i").collect())   # a row per dimension
        self.n = got[0]["n"] if got else 0
        self.sums = [(int(r["high"]) << 26) + int(r["low"]) for r in got]
        self.d = len(got)
        whole = [s // self.n for s in self.sums]
        self.whole = np.array(whole, np.int64)
        self.rest = np.array([(s - w * self.n) / self.n for s, w in zip(self.sums, whole)])

    def added(self, partial, shape) -> np.ndarray:
        """The sum over all rows of ``partial`` of their centred matrix; one
        matrix of ``shape`` per task, added in tasks beyond FAN_IN."""
        whole, rest = self.whole, self.rest

        def product(batches):
            total = np.zeros(shape)
            for batch in batches:
                x = _matrix(batch.column("x"))
                for at in range(0, len(x), ROWS):
                    total += partial((x[at:at + ROWS] - whole) - rest)
            yield pa.RecordBatch.from_pydict({"m": [total.tobytes()]})

        def add(batches):
            total = np.zeros(shape)
            for batch in batches:
                for m in batch.column("m"):
                    total += np.frombuffer(m.as_py()).reshape(shape)
            yield pa.RecordBatch.from_pydict({"m": [total.tobytes()]})

        sums = self.vectors.select("x").mapInArrow(product, "m binary")
        width = self.parts
        while width > FAN_IN:
            width = math.ceil(width / FAN_IN)
            sums = sums.repartition(width).mapInArrow(add, "m binary")
        return sum((np.frombuffer(bytes(r["m"])).reshape(shape) for r in sums.collect()), np.zeros(shape))

    def times(self, block: np.ndarray) -> np.ndarray:
        """The covariance times ``block``."""
        return self.added(lambda x: x.T @ (x @ block), block.shape) / self.n

    def trace(self) -> tuple[float, np.ndarray]:
        """The covariance's trace and the mean that is left after centring."""
        got = self.added(lambda x: np.vstack([(x * x).sum(axis=0), x.sum(axis=0)]), (2, self.d)) / self.n
        return float(got[0].sum()), got[1]


def chebyshev(times, block: np.ndarray, end: float, top: float, degree: int) -> np.ndarray:
    """The Chebyshev polynomial of the interval [0, end] applied to the block,
    scaled to stay near one at ``top``: small inside the interval, growing
    steeply above it."""
    half = end / 2
    sigma = first = half / (top - half)
    before, now = block, (times(block) - half * block) * (first / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        before, now = now, (times(now) - half * now) * (2 * after / half) - before * (sigma * after)
        sigma = after
    return now


def degree_for(top: float, wanted: float, end: float) -> int:
    """The filter's degree: as high as rounding allows. What the polynomial
    makes of ``top`` may exceed what it makes of ``wanted`` by SPAN only, or
    the block's lower columns would drown in the uppermost vector."""
    steep = lambda v: math.acosh(max(2 * v / end - 1, 1.0))
    apart = steep(top) - steep(wanted)
    return MAX_DEGREE if apart <= 0 else max(2, min(MAX_DEGREE, int(math.log(SPAN) / apart)))


def ritz(block: np.ndarray, image: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values (falling), Ritz vectors and residual norms in the block."""
    small = block.T @ image
    values, turn = np.linalg.eigh((small + small.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    block = block @ turn
    return values, block, np.linalg.norm(image @ turn - block * values, axis=0)


def leading(times, d: int, k: int, trace: float, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues (falling) and unit eigenvectors, certified.
    Certified leading pairs are held and projected out, so that the filter
    can be steep for the next ones; at the end all are certified once more."""
    width = min(d, k + GUARD)
    k = min(k, width)
    if trace <= 0:
        return np.zeros(0), np.zeros((d, 0))
    block, held, top = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, width)))[0], np.zeros((d, 0)), 0.0
    for _ in range(MAX_ROUNDS):
        def inside(q, held=held):
            image = times(q)
            return image - held @ (held.T @ image)

        values, block, rest = ritz(block, inside(block))
        top = max(top, values[0])
        good = int(np.argmax(rest > CERTIFIED * top)) if (rest > CERTIFIED * top).any() else len(rest)
        good = min(good, k - held.shape[1])
        held, values, block = np.hstack([held, block[:, :good]]), values[good:], block[:, good:]
        if held.shape[1] == k:
            found, axes, rest = ritz(held, times(held))
            if rest.max() <= 2 * CERTIFIED * top:
                some = int((found > FLAT * trace).sum())
                return found[:some], axes[:, :some]
            block, held = np.hstack([axes, block]), np.zeros((d, 0))
            continue
        end = max(values[-1], FLAT * trace)
        now, wanted = max(values[0], 2 * end), values[k - held.shape[1] - 1]
        block = chebyshev(inside, block, end, now, degree_for(now, wanted, end))
        block -= held @ (held.T @ block)
        block = np.linalg.qr(block)[0]
        block -= held @ (held.T @ block)
        block = np.linalg.qr(block)[0]
    raise ArithmeticError(f"no certified components after {MAX_ROUNDS} rounds (residual {rest.max() / top:.1e})")


SCHEMA = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
          "identity_error double")


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Per row the exact sum of (n x - sum)^2; null beyond a long."""
    rough = ((x - np.array([s / n for s in sums])) * float(n)) ** 2
    if n * (abs(int(x.min())) + abs(int(x.max())) + 1) < 1 << 62 and max(map(abs, sums)) < 1 << 62 and rough.sum(axis=1).max() < 2.0 ** 62:
        from_mean = n * x - np.array(sums, np.int64)
        return (from_mean * from_mean).sum(axis=1).tolist()
    found = (sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x)
    return [v if v < 1 << 63 else None for v in found]


def whiten(embeddings: DataFrame, k: int = 32) -> DataFrame:
    """A row per vector and component (from 1, by falling eigenvalue): vec_id,
    component, n, deviation, whitened, explained, identity_error."""
    vectors = integer_rows(embeddings)
    rows = Rows(vectors)
    if rows.n == 0:
        return embeddings.sparkSession.createDataFrame([], SCHEMA)
    trace, left = rows.trace()
    values, axes = leading(rows.times, rows.d, k, trace)
    if not len(values):
        return embeddings.sparkSession.createDataFrame([], SCHEMA)
    scaled = axes / np.sqrt(values)
    mean = left @ scaled
    identity = rows.added(lambda x: (x @ scaled - mean).T @ (x @ scaled - mean), (len(values),) * 2) / rows.n
    error = float(np.abs(identity - np.eye(len(values))).max())
    explained = values / trace
    whole, rest, n, sums = rows.whole, rows.rest, rows.n, rows.sums
    count = len(values)

    def project(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x = _matrix(part.column("x"))
                white = ((x - whole) - rest) @ scaled
                away = pa.array(deviations(x, n, sums), pa.int64())
                each = np.repeat(np.arange(len(x)), count)
                yield pa.RecordBatch.from_arrays([
                    part.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(each), n)), away.take(pa.array(each)), pa.array(white.ravel()),
                    pa.array(np.tile(explained, len(x))), pa.array(np.full(len(each), error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "x").mapInArrow(project, SCHEMA)
