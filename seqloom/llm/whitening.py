"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its triangular factor.

Entries become whole numbers x = floor(scale * c) + base, so that the count n, the sums S and the deviations are exact. The
fit list is each distinct x vector once; copies, however many, leave a task as one row. Scatter of the centred vectors
(n*x-S)/n is summed in tasks and then by Spark, entry by entry; only what is bounded by the number of dimensions (its
square at most) reaches the driver, never rows. There the scatter is factored, P'CP = LL', and columns of L are rotated in
pairs until all are orthogonal: their squared norms are the eigenvalues, and the columns at unit length the components,
without forming C again. Tasks then project every row.

Defined results: rows whose vector is null or holds a null, a non-finite entry or one beyond ``LARGEST`` (which has no
exact x) have no rows in the result, nor do vectors of another length than most have (of equally many, the longer).
Null and repeated ids are kept, each row gives its own rows. Components without variance are left out, so one distinct
vector, or an empty table, gives no rows. Columns other than the two named are not read.
"""

from __future__ import annotations

import decimal
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import ship, small, staged

LARGEST = float(1 << 30)
ROWS = 2048


@dataclass(frozen=True)
class Whitening:
    """What is known of the fit list: n distinct vectors, their sums by dimension (of x without base), the components (a
    column each) and their variances, of all variances' sum."""

    n: int
    sums: tuple[int, ...]
    scale: int
    base: int
    components: np.ndarray
    variances: np.ndarray
    trace: float

    def multiples(self, whole: np.ndarray) -> np.ndarray:
        """n*x-S, exact: whole numbers of 64 bits where they fit, else Python's."""
        most = self.n * max(int(np.abs(whole).max(initial=0)), 1) + max(map(abs, self.sums))
        kind = np.int64 if most < 1 << 62 else object
        return whole.astype(kind) * self.n - np.array(self.sums, kind)

    def centred(self, whole: np.ndarray) -> np.ndarray:
        return (self.multiples(whole) / self.n).astype(np.float64)

    @property
    def projection(self) -> np.ndarray:
        return self.components / np.sqrt(self.variances)


def usable(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, int]:
    """vec_id, vector of the rows that take part, and their number of dimensions."""
    fine = F.forall("vector", lambda c: c.isNotNull() & (F.abs(c) <= LARGEST))
    rows = table.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector")).where(F.col("vector").isNotNull() & F.coalesce(fine, F.lit(False)))
    most = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = most["d"] if most else 0
    return rows.where(F.size("vector") == d), d


def wholes(column, d: int, scale: int) -> np.ndarray:
    """floor(scale * c) of a batch of vectors."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(scale * values).astype(np.int64).reshape(-1, d)


def packed(whole: np.ndarray) -> pa.Array:
    """Vectors as bytes: two an entry where all entries of a vector fit, else eight."""
    short = (np.abs(whole) < 1 << 15).all(axis=1)
    rows = [r.tobytes() for r in whole.astype("<i8")] if not short.all() else None
    slim = [r.tobytes() for r in whole.astype("<i2")]
    return pa.array([s if f else rows[i] for i, (s, f) in enumerate(zip(slim, short, strict=True))], pa.binary())


def unpacked(column, d: int) -> np.ndarray:
    out = np.empty((len(column), d), np.int64)
    for i, b in enumerate(column.to_pylist()):
        out[i] = np.frombuffer(b, "<i2" if len(b) == 2 * d else "<i8")
    return out


def fit_list(rows: DataFrame, d: int, scale: int) -> DataFrame:
    """x: each distinct vector once, packed and without base."""

    def run(batches):
        for b in small(batches, ROWS):
            yield pa.RecordBatch.from_arrays([packed(wholes(b.column(0), d, scale))], ["x"])

    return staged(rows.select("vector").mapInArrow(run, "x binary").distinct(), "whitening-fit")


def totals(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """How many vectors, and their sums by dimension; d + 1 rows reach the driver."""

    def run(batches):
        n, sums = 0, np.zeros(d, np.int64)
        for b in small(batches, ROWS):
            n += b.num_rows
            sums += unpacked(b.column(0), d).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, d), pa.int32()), pa.array([n, *sums.tolist()], pa.int64())], ["at", "total"])

    found = dict(fit.mapInArrow(run, "at int, total long").groupBy("at").agg(F.sum(F.col("total").cast("decimal(38,0)"))).collect())
    return int(found.get(-1, 0)), [int(found.get(i, 0)) for i in range(d)]


def products(fit: DataFrame, d: int, k: int, of) -> np.ndarray:
    """The k x k sum of the outer products of what ``of`` makes of each vector: in tasks, then entry by entry by Spark."""
    up = np.triu_indices(k)

    def run(batches):
        total = np.zeros((k, k))
        for b in small(batches, ROWS):
            w = of(unpacked(b.column(0), d))
            total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(up[0], pa.int32()), pa.array(up[1], pa.int32()), pa.array(total[up])], ["i", "j", "v"])

    found = fit.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()  # k*(k+1)/2 rows
    out = np.zeros((k, k))
    out[found["i"].to_numpy(), found["j"].to_numpy()] = found["v"].to_numpy()
    return out + np.triu(out, 1).T


def cholesky(c: np.ndarray) -> np.ndarray:
    """L of as many columns as ``c`` has rank, with LL' = c: the largest entry that is left on the diagonal goes next. Its rows
    stand in the order of ``c``; in the order of the pivots it is lower triangular."""
    d = len(c)
    left, order, low = np.diag(c).copy(), np.arange(d), np.zeros((d, d))
    least = d * np.finfo(float).eps * left.max(initial=0.0)
    for k in range(d):
        p = k + int(np.argmax(left[order[k:]]))
        if left[order[p]] <= least:
            return low[:, :k]
        order[[k, p]] = order[[p, k]]
        now, rest = order[k], order[k + 1 :]
        low[now, k] = math.sqrt(left[now])
        low[rest, k] = (c[rest, now] - low[rest, :k] @ low[now, :k]) / low[now, k]
        left[rest] -= low[rest, k] ** 2
    return low


def jacobi(low: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Squared norms, falling, and unit columns of ``low`` after rotations of pairs of columns have made all orthogonal. A
    sweep meets every pair once, in rounds of disjoint pairs that are rotated at once."""
    a = low.copy()
    r = a.shape[1]
    seats = [*range(r), *([-1] if r % 2 else [])]
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(len(seats) - 1):
            half = len(seats) // 2
            pairs = [(x, y) for x, y in zip(seats[:half], seats[: half - 1 : -1], strict=True) if x >= 0 and y >= 0]
            seats = [seats[0], seats[-1], *seats[1:-1]]
            if not pairs:
                continue
            i, j = np.array(pairs).T
            x, y = a[:, i], a[:, j]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            off = np.abs(xy) / np.sqrt(xx * yy)
            turn = off > 1e-16
            worst = max(worst, float(off.max()))
            tau = (yy - xx) / np.where(turn, 2 * xy, 1.0)
            t = np.where(turn, np.where(tau >= 0, 1.0, -1.0) / (np.abs(tau) + np.sqrt(1 + tau * tau)), 0.0)
            c = 1 / np.sqrt(1 + t * t)
            a[:, i], a[:, j] = c * x - c * t * y, c * t * x + c * y
        if worst < 1e-15:
            break
    norms = (a * a).sum(0)
    order = np.argsort(-norms, kind="stable")
    unit = a[:, order] / np.sqrt(norms[order])
    flip = np.sign(unit[np.argmax(np.abs(unit), axis=0), np.arange(unit.shape[1])]) if unit.size else np.ones(0)
    return norms[order], unit * flip


def learn(fit: DataFrame, d: int, components: int, scale: int, base: int) -> Whitening | None:
    """The fit list's components, most variance first; None where nothing varies."""
    n, sums = totals(fit, d)
    if not n:
        return None
    bare = Whitening(n, tuple(sums), scale, base, np.zeros((d, 0)), np.zeros(0), 0.0)
    scatter = products(fit, d, d, bare.centred) / n
    norms, unit = jacobi(cholesky(scatter))
    if not len(norms):
        return None
    k = min(components, len(norms))
    return Whitening(n, tuple(sums), scale, base, unit[:, :k], norms[:k], float(np.trace(scatter)))


def identity_error(fit: DataFrame, d: int, w: Whitening) -> float:
    """How far the covariance of the whitened fit list is from the identity, measured over it. Its mean is zero, as the
    vectors are centred exactly."""
    k = len(w.variances)
    return float(np.abs(products(fit, d, k, lambda x: w.centred(x) @ w.projection) / w.n - np.eye(k)).max())


def whitened(table: DataFrame, components: int = 16, scale: int = 64, base: int = 1_000_000, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, component (from 1), n, deviation (sum of (n*x-S)^2, exact; null from 10^38 on), whitened, explained, identity_error:
    a row for each usable row of ``table`` and component."""
    spark = table.sparkSession
    ship(spark)
    rows, d = usable(table, vec_id, vector)
    kind = dict(rows.dtypes)["vec_id"]
    schema = f"vec_id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    w = None
    if d:
        fit = fit_list(rows, d, scale)
        w = learn(fit, d, components, scale, base)
    if w is None:
        return spark.createDataFrame([], schema)
    error, k, shares = identity_error(fit, d, w), len(w.variances), w.variances / w.trace

    def run(batches):
        for b in small(batches, ROWS):
            many = w.multiples(wholes(b.column("vector"), d, scale))
            if many.dtype == np.int64 and d * int(np.abs(many).max(initial=0)) ** 2 < 1 << 63:
                deviation = pa.array((many * many).sum(axis=1)).cast(pa.decimal128(38, 0))
            else:
                sums = (sum(int(v) ** 2 for v in r) for r in many)
                deviation = pa.array([decimal.Decimal(s) if s < 10**38 else None for s in sums], pa.decimal128(38, 0))
            white = (many / w.n).astype(np.float64) @ w.projection
            of = pa.array(np.repeat(np.arange(len(many)), k))
            full = lambda v: pa.array(np.full(len(of), v))
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id").take(of), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(many))), full(w.n), deviation.take(of), pa.array(white.ravel()), pa.array(np.tile(shares, len(many))), full(error)],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.select("vec_id", "vector").mapInArrow(run, schema)
