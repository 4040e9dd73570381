"""Embedding whitening by spectrum slicing.

Vectors become integers (see ``images``), so counts, sums and products are exact and do
not depend on the order in which tasks finish. The fit list holds each distinct vector
once. One pass over it gives the sums S, the next the products of the vectors centred at
the rounded mean; what the rounding left is taken out exactly, and the covariance V is
rounded once, to double.

V has as many rows as a vector has entries, and is worked on where it arrives:
- The number of eigenvalues above s is the number of positive pivots of V - s I = L D L'
  (Sylvester's law of inertia). Bisection by these counts isolates each leading
  eigenvalue: the count falls from k or more to k - 1 within its interval.
- Inverse iteration in the interval, then Rayleigh quotient iteration, which converges
  cubically, give value and vector. A result outside the interval belongs to another
  component: the interval is halved further and the iteration repeated.
- Counts just above and below the value certify its number.
Equal eigenvalues cannot be isolated; their vectors are made orthogonal to those found.

Scale: distinct vectors are combined before their shuffle, so a vector that stands in a
third of all rows is one row per task. Tasks send one row per dimension, or pair of
dimensions, into a grouped sum. Only S and V come to the driver. The covariance of the
whitened fit list is measured in a pass of its own.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import written

SCALE, SHIFT = 64, 1_000_000
#: Integer entries end here, so that products of two centred ones fit a long.
LIMIT = 1 << 30
_FLAT = 1e-10       # a share of the trace up to which an eigenvalue counts as zero
_EPS = np.finfo(float).eps
_EXACT = decimal.Context(prec=60)


def inertia(a: np.ndarray) -> int:
    """Number of positive eigenvalues of a symmetric matrix, from the pivots of its LDL'
    factorisation with symmetric (Bunch-Kaufman) pivoting."""
    a, n, k, positive = a.copy(), len(a), 0, 0
    alpha = (1 + math.sqrt(17)) / 8

    def swap(i: int, j: int) -> None:
        if i != j:
            a[[i, j], k:] = a[[j, i], k:]
            a[k:, [i, j]] = a[k:, [j, i]]

    while k < n:
        below = np.abs(a[k + 1:, k])
        r = k + 1 + int(below.argmax()) if len(below) else k
        most, two = (below[r - k - 1] if len(below) else 0.0), False
        if most > 0 and abs(a[k, k]) < alpha * most:
            row = np.abs(a[r, k:])
            row[r - k] = 0
            widest = row.max()
            if abs(a[k, k]) * widest < alpha * most * most:
                two = abs(a[r, r]) < alpha * widest
                swap(k + 1 if two else k, r)
        if two:
            block = a[k:k + 2, k:k + 2]
            positive += 1       # such a block is indefinite: one pivot of each sign
            if k + 2 < n:
                side = a[k + 2:, k:k + 2].copy()
                a[k + 2:, k + 2:] -= side @ np.linalg.solve(block, side.T)
            k += 2
        else:
            positive += a[k, k] > 0
            if a[k, k] != 0 and most > 0:
                side = a[k + 1:, k].copy()
                a[k + 1:, k + 1:] -= np.outer(side, side / a[k, k])
            k += 1
    return int(positive)


class Slices:
    """Counts of eigenvalues above a shift, and the intervals they leave for each number."""

    def __init__(self, v: np.ndarray):
        self.v, self.size = v, float(np.abs(v).sum(axis=1).max())       # no eigenvalue is larger
        top = self.size * (1 + 1e-9) + 1e-300
        self.known: dict[float, int] = {top: 0, -top: len(v)}

    def above(self, shift: float) -> int:
        if shift not in self.known:
            self.known[shift] = inertia(self.v - shift * np.eye(len(self.v)))
        return self.known[shift]

    def interval(self, k: int) -> tuple[float, float]:
        """The narrowest known interval around the k-th largest eigenvalue."""
        return (max(s for s, n in self.known.items() if n >= k), min(s for s, n in self.known.items() if n < k))

    def halve(self, k: int) -> None:
        low, high = self.interval(k)
        self.above(low + (high - low) / 2)

    def isolated(self, k: int) -> bool:
        low, high = self.interval(k)
        return self.above(low) == k and self.above(high) == k - 1

    def narrow(self, k: int) -> bool:
        low, high = self.interval(k)
        return high - low <= 8 * _EPS * self.size


def _solve(v: np.ndarray, shift: float, x: np.ndarray, found: np.ndarray) -> np.ndarray:
    """A step of inverse iteration, kept orthogonal to the vectors ``found`` (rows)."""
    n = len(v)
    with np.errstate(all="ignore"):
        try:
            y = np.linalg.solve(v - shift * np.eye(n), x)
        except np.linalg.LinAlgError:
            y = np.full(n, np.nan)
        if not np.isfinite(y).all():        # the shift is an eigenvalue to the last bit
            y = np.linalg.solve(v - (shift + 4 * _EPS * (np.abs(v).sum(axis=1).max() or 1.0)) * np.eye(n), x)
    y /= np.abs(y).max()        # near an eigenvalue the entries may be too large to square
    y /= np.linalg.norm(y)
    for _ in range(2):
        y -= found.T @ (found @ y)
    return y / np.linalg.norm(y)


def _component(slices: Slices, k: int, found: np.ndarray) -> tuple[float, np.ndarray]:
    """Value and vector of the k-th largest eigenvalue, certified by counts."""
    v, size = slices.v, slices.size
    while not slices.isolated(k) and not slices.narrow(k):
        slices.halve(k)
    start = np.random.default_rng(k).normal(size=len(v))
    while True:
        low, high = slices.interval(k)
        x, shift = start, low + (high - low) / 2
        for _ in range(2):
            x = _solve(v, shift, x, found)
        last = math.inf
        for _ in range(12):
            value = float(x @ v @ x)
            wrong = float(np.linalg.norm(v @ x - value * x))
            if wrong >= last / 2 and wrong <= 1e-10 * size:
                break
            last = wrong
            x = _solve(v, value, x, found)
        value = float(x @ v @ x)
        wrong = float(np.linalg.norm(v @ x - value * x)) + 64 * _EPS * size
        if (low - wrong <= value <= high + wrong and wrong <= 1e-9 * size
                and slices.above(value - 2 * wrong) >= k > slices.above(value + 2 * wrong)):
            return value, x
        if slices.narrow(k):
            raise ArithmeticError(f"no certified eigenvalue for component {k}")
        for _ in range(4):
            slices.halve(k)


def leading(v: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a covariance, falling, and their unit vectors (rows); at most
    ``components``, and none that is zero to double precision."""
    values, vectors = [], np.zeros((0, len(v)))
    trace = float(np.trace(v)) if len(v) else 0.0
    if trace > 0:
        slices = Slices(v)
        for k in range(1, min(components, slices.above(_FLAT * trace)) + 1):
            value, vector = _component(slices, k, vectors)
            values.append(value)
            vectors = np.vstack([vectors, vector])
    return np.array(values), vectors


@dataclass
class Whitening:
    """A fitted whitening: exact count and sums, and the leading components."""
    n: int
    sums: list[int]
    trace: float
    values: np.ndarray          # k
    vectors: np.ndarray         # k x dimensions
    identity_error: float | None = None

    @property
    def mean(self) -> np.ndarray:
        return np.array([round(s / self.n) for s in self.sums], dtype=np.int64)

    @property
    def rest(self) -> list[int]:
        """n times what the rounded mean leaves: sums of the centred vectors."""
        return [s - self.n * int(m) for s, m in zip(self.sums, self.mean)]

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows of integer vectors."""
        centred = (x - self.mean) - np.array([r / self.n for r in self.rest])
        return centred @ (self.vectors / np.sqrt(self.values)[:, None]).T

    def deviations(self, x: np.ndarray) -> list[int]:
        """Exact sum of (n x - S)^2 of each row."""
        if not len(x):
            return []
        y, rest = x - self.mean, np.array(self.rest, dtype=object)
        widest = self.n * int(np.abs(y).max()) + max(abs(int(r)) for r in rest)
        if x.shape[1] * widest * widest < 1 << 63:
            return ((self.n * y - rest.astype(np.int64)) ** 2).sum(axis=1).tolist()
        return ((y.astype(object) * self.n - rest) ** 2).sum(axis=1).tolist()


def images(df: DataFrame, vector: str, keep: list[str]) -> DataFrame:
    """``row`` (the columns ``keep``) and ``x`` of every row whose vector has entries, all of them finite:
    x = floor(64 c) + 1000000 as long, held within +-2**30 (entries beyond 16 million)."""
    v = F.col(f"`{vector}`").cast("array<double>")

    def image(c):
        whole = F.floor(F.least(F.greatest(c * SCALE, F.lit(-float(LIMIT))), F.lit(float(LIMIT))))
        return F.least(F.greatest(whole.cast("long") + SHIFT, F.lit(-LIMIT)), F.lit(LIMIT)).cast("long")

    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    row = F.struct(*[F.col(f"`{c}`") for c in keep])
    return df.where(F.coalesce((F.size(v) > 0) & fine, F.lit(False))).select(row.alias("row"), F.transform(v, image).alias("x"))


def _matrix(column: pa.ListArray, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _sums(fit: DataFrame, size: int) -> tuple[int, list[int]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = 0, np.zeros(size, dtype=np.int64)
        for batch in batches:
            n += batch.num_rows
            s += _matrix(batch.column(0), size).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, size)), pa.array(np.r_[n, s])], ["at", "s"])

    got = dict(fit.select("x").mapInArrow(run, "at long, s long").groupBy("at").agg(F.sum("s").alias("s")).collect())
    return got.get(-1, 0), [got.get(i, 0) for i in range(size)]


def _products(fit: DataFrame, mean: np.ndarray) -> list[list[int]]:
    """Exact sums of the products of vectors centred at ``mean``, in two limbs of 32 bits and up."""
    size, part = len(mean), 1 << 32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size), dtype=object)
        some, room = np.zeros((size, size), dtype=np.int64), (1 << 62)
        for batch in batches:
            if not batch.num_rows:
                continue
            y = _matrix(batch.column(0), size) - mean
            bound = int(np.abs(y).max()) ** 2 * len(y)
            if bound < 1 << 53:
                block = (y.T.astype(float) @ y.astype(float)).astype(np.int64)     # whole numbers: no rounding
            elif bound < 1 << 62:
                block = y.T @ y
            else:
                total += y.T.astype(object) @ y.astype(object)
                continue
            if bound >= room:
                total += some
                some, room = np.zeros((size, size), dtype=np.int64), (1 << 62)
            some += block
            room -= bound
        flat = [int(t) for t in (total + some)[np.triu_indices(size)]]
        i, j = np.triu_indices(size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int64)), pa.array(j.astype(np.int64)), pa.array([t // part for t in flat], pa.int64()),
             pa.array([t % part for t in flat], pa.int64())], ["i", "j", "high", "low"])

    got = (fit.select("x").mapInArrow(run, "i long, j long, high long, low long").groupBy("i", "j")
           .agg(F.sum("high"), F.sum("low")).collect())     # a row per pair of dimensions
    out = [[0] * size for _ in range(size)]
    for i, j, high, low in got:
        out[i][j] = out[j][i] = high * part + low
    return out


def _identity_error(fit: DataFrame, w: Whitening) -> float | None:
    """Largest entry of the whitened fit list's covariance minus the identity."""
    k = len(w.values)
    if not k:
        return None
    size = len(w.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the mean's place is an extra column of ones
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            if batch.num_rows:
                z = np.c_[w.project(_matrix(batch.column(0), size)), np.ones(batch.num_rows)]
                total += z.T @ z
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], ["i", "j", "v"])

    total = np.zeros((k + 1, k + 1))
    for i, j, v in fit.select("x").mapInArrow(run, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v")).collect():
        total[i, j] = v
    mean = total[-1, :k] / w.n
    return float(np.abs(total[:k, :k] / w.n - np.outer(mean, mean) - np.eye(k)).max())


def fit(rows: DataFrame, components: int = 16) -> Whitening:
    """Fit on the distinct vectors ``x`` of ``rows``; of those, on the ones of the commonest length
    (ties: the longer)."""
    vectors = written(rows.select("x").distinct(), "fit-list")
    first = vectors.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if first is None:
        return Whitening(0, [], 0.0, np.array([]), np.zeros((0, 0)))
    same = vectors.where(F.size("x") == first["size"])
    n, sums = _sums(same, first["size"])
    w = Whitening(n, sums, 0.0, np.array([]), np.zeros((0, first["size"])))
    products, rest = _products(same, w.mean), w.rest
    v = np.array([[(n * g - a * b) / (n * n) for g, b in zip(line, rest)] for line, a in zip(products, rest)])
    w.trace = float(np.trace(v))
    w.values, w.vectors = leading(v, components)
    w.identity_error = _identity_error(same, w)
    return w


def transform(rows: DataFrame, w: Whitening) -> DataFrame:
    """``row``, ``deviation`` (decimal) and ``whitened`` (one double per component) of each of ``rows``
    that has the fitted length."""
    size, k = len(w.sums), len(w.values)
    schema = StructType([rows.schema["row"], *StructType.fromDDL("deviation decimal(38,0), whitened array<double>").fields])
    of_size = rows.where(F.size("x") == size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), size)
            gone = [_EXACT.create_decimal(d) for d in w.deviations(x)]
            z = w.project(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(gone, pa.decimal128(38, 0)),
                 pa.ListArray.from_arrays(np.arange(0, len(x) * k + 1, k, dtype=np.int32) if k else np.zeros(len(x) + 1, dtype=np.int32),
                                          pa.array(z.ravel()))], ["row", "deviation", "whitened"])

    return of_size.mapInArrow(run, schema)


def whiten(df: DataFrame, vector: str = "embedding", components: int = 16, keep: list[str] | None = None) -> tuple[DataFrame, Whitening]:
    """Whitened rows of ``df`` and the fitted whitening.

    Rows: ``row`` (the columns ``keep``; all by default, so no name can clash), ``deviation`` (exact
    sum over dimensions of (n x - S)^2, decimal) and ``whitened``, the projections of x - S / n on the
    leading components over the roots of their eigenvalues. The covariance has divisor n, the number of
    distinct vectors.

    Null vectors, vectors with null, NaN or infinite entries, empty vectors, and vectors of another
    length than the commonest give no row. Repeated vectors give a row each and count once in the fit.
    Null ids are rows like any other. Fewer components where the distinct vectors span fewer
    dimensions (a single one: none). Equal eigenvalues: any orthonormal vectors of their space. Empty
    table: no rows.
    """
    rows = images(df, vector, keep or df.columns)
    w = fit(rows, components)
    return transform(rows, w), w


def by_component(rows: DataFrame, w: Whitening) -> DataFrame:
    """One row per vector and component: row, component (from 1), n, deviation, whitened, explained, identity_error."""
    explained = F.array(*[F.lit(float(e / w.trace)) for e in w.values]) if len(w.values) else F.lit(None).cast("array<double>")
    each = rows.select("row", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select("row", (F.col("at") + 1).alias("component"), F.lit(w.n).cast("long").alias("n"), "deviation", "whitened",
                       F.get(explained, F.col("at")).alias("explained"), F.lit(w.identity_error).cast("double").alias("identity_error"))
