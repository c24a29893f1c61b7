"""Whitening of embeddings: covariance summed over the cluster, its leading eigenvectors found on the driver, a projection sent to all rows.

Only sums leave the tasks: one number per dimension, then one per pair of dimensions. The symmetric matrix of all dimensions is brought to tridiagonal form by
Householder reflections; Sturm counts bisect for the leading eigenvalues; inverse iteration finds their vectors, those of close eigenvalues made orthogonal to
each other; the reflections carry them back.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pitwall.sources.scratch import staged

#: Fixed-point steps of one unit.
SCALE = 256
#: Components of the query.
COMPONENTS = 4
#: Dimensions the driver takes a matrix of.
MOST_DIMENSIONS = 4096
#: Partial sums that meet in one task on their way.
MEET = 64
#: Eigenvalues nearer than this share of the largest are a cluster, whose vectors are made orthogonal.
CLOSE = 1e-3


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal and off-diagonal of Q^T a Q, and the unit vectors of the reflections that make up Q."""
    a, n, mirrors = a.astype(np.float64).copy(), len(a), []
    for k in range(n - 2):
        v = a[k + 1 :, k].copy()
        size = np.linalg.norm(v)
        if size > 0:
            v[0] += np.copysign(size, v[0])
            v /= np.linalg.norm(v)
            below = a[k + 1 :, k + 1 :]
            p = below @ v
            p -= (v @ p) * v
            below -= 2 * (np.outer(v, p) + np.outer(p, v))
            a[k + 1 :, k] -= 2 * (v @ a[k + 1 :, k]) * v
        mirrors.append(v)
    return np.diag(a).copy(), np.array([a[i + 1, i] for i in range(n - 1)]), mirrors


def count_below(d: np.ndarray, e: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Eigenvalues of the tridiagonal matrix below each x: the negative terms of its Sturm sequence."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    square = np.r_[0.0, e * e]
    q, below = np.ones_like(x), np.zeros(len(x), np.int64)
    for i in range(len(d)):
        q = d[i] - x - square[i] / q
        q = np.where(np.abs(q) < tiny, -tiny, q)
        below += q < 0
    return below


def leading_eigenvalues(d: np.ndarray, e: np.ndarray, most: int) -> np.ndarray:
    """The `most` largest eigenvalues, falling: intervals from Gershgorin's circles are halved by Sturm counts until they are two neighbouring numbers."""
    n = len(d)
    reach = np.r_[0.0, np.abs(e)] + np.r_[np.abs(e), 0.0]
    slack = np.finfo(float).eps * n * (np.abs(d) + reach).max() + np.finfo(float).tiny
    low, high = np.full(most, (d - reach).min() - slack), np.full(most, (d + reach).max() + slack)
    rank = n - 1 - np.arange(most)
    while True:
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high)).all():
            return middle
        up = count_below(d, e, middle) <= rank
        low, high = np.where(up, middle, low), np.where(up, high, middle)


def _solve(d: np.ndarray, e: np.ndarray, x: float, b: np.ndarray) -> np.ndarray:
    """(T - x) y = b by elimination with row exchanges; a vanishing pivot becomes the smallest one that matters."""
    n, least = len(d), np.finfo(float).eps * max(np.abs(d).max(), np.abs(e).max(initial=0.0), np.finfo(float).tiny)
    u0, u1, u2, y = d - x, np.r_[e, 0.0], np.zeros(n), b.copy()
    for i in range(n - 1):
        below, nxt, after = e[i], u0[i + 1], u1[i + 1]
        if abs(below) > abs(u0[i]):
            u0[i], below, u1[i], nxt, u2[i], after = below, u0[i], nxt, u1[i], after, 0.0
            y[i], y[i + 1] = y[i + 1], y[i]
        elif abs(u0[i]) < least:
            u0[i] = least
        m = below / u0[i]
        u0[i + 1], u1[i + 1] = nxt - m * u1[i], after - m * u2[i]
        y[i + 1] -= m * y[i]
    if abs(u0[-1]) < least:
        u0[-1] = least
    for i in range(n - 1, -1, -1):
        if i + 1 < n:
            y[i] -= u1[i] * y[i + 1]
        if i + 2 < n:
            y[i] -= u2[i] * y[i + 2]
        y[i] /= u0[i]
        big = np.abs(y[i])
        if big > 1e150:
            y /= big
    return y


def inverse_iteration(d: np.ndarray, e: np.ndarray, values: np.ndarray, rounds: int = 5) -> np.ndarray:
    """Unit eigenvectors (as columns) of falling eigenvalues; equal and close ones get orthogonal vectors."""
    n, rng, out = len(d), np.random.default_rng(1), []
    near, start = CLOSE * np.abs(values).max(initial=0.0), 0
    for k, x in enumerate(values):
        if k and values[k - 1] - x > near:
            start = k
        y = rng.standard_normal(n)
        for _ in range(rounds):
            y = _solve(d, e, x, y / np.linalg.norm(y))
            y /= np.linalg.norm(y)
            for _ in range(2):
                for other in out[start:k]:
                    y -= (other @ y) * other
        out.append(y / np.linalg.norm(y))
    return np.array(out).T.reshape(n, len(values))


def leading_eigenvectors(a: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric matrix, falling, and their unit vectors as columns."""
    scale = np.abs(a).max(initial=0.0) or 1.0
    d, e, mirrors = tridiagonal(a / scale)
    values = leading_eigenvalues(d, e, min(most, len(a)))
    vectors = inverse_iteration(d, e, values)
    for k in range(len(mirrors) - 1, -1, -1):
        v = mirrors[k]
        vectors[k + 1 :] -= 2 * np.outer(v, v @ vectors[k + 1 :])
    return values * scale, vectors / np.linalg.norm(vectors, axis=0)


def fixed_point(vector: Column) -> Column:
    """Each entry, as a double, in whole steps of 1 / SCALE, rounded down; null for a null vector or one with a null or non-finite entry."""
    entries = F.transform(vector, lambda c: c.cast("double"))
    bad = F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.when(vector.isNotNull() & ~bad, F.transform(entries, lambda c: F.floor(c * SCALE).cast("long")))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """A list column as a matrix of long numbers; what a shorter vector lacks is zero."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (sizes == dims).all():
        return flat.reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _summed(rows: DataFrame, of: Callable[[np.ndarray], np.ndarray], dims: int, kind: str) -> np.ndarray:
    """The sum over all rows (column x) of a matrix computed from some of them at a time.

    Each task adds up its own; up to MEET of these sums meet in a task, matrix row by matrix row, then all. Only the final sum reaches the driver.
    """
    dtype = np.int64 if kind == "long" else np.float64

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                part = of(_matrix(b.column(0), dims))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())], names=["i", "part"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple, np.ndarray] = {}
        for b in batches:
            for i, salt, part in zip(*(c.to_pylist() for c in b.columns)):
                v = np.frombuffer(part, dtype)
                total[i, salt] = total[i, salt] + v if (i, salt) in total else v
        keys = sorted(total)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int32()), pa.array([total[k].tobytes() for k in keys], pa.binary())], names=["i", "part"])

    parts = rows.select("x").mapInArrow(own, "i int, part binary").withColumn("salt", F.spark_partition_id() % MEET)
    for keys in (["i", "salt"], ["i"]):
        parts = parts.repartition(*keys).select("i", "salt" if "salt" in keys else F.lit(0).alias("salt"), "part").mapInArrow(meet, "i int, part binary")
        parts = parts.withColumn("salt", F.lit(0))
    found = sorted((r["i"], bytes(r["part"])) for r in parts.select("i", "part").collect())
    return np.array([np.frombuffer(p, dtype) for _, p in found])


@dataclass
class Whitening:
    """What whitens a row: n fitted vectors, their sums per dimension, the leading eigenvalues, their vectors as columns, and the variance in all."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x less the mean: the whole and the fractional part of the mean are taken off apart, so nothing is rounded away."""
        whole, rest = np.divmod(self.sums, self.n) if self.n else (self.sums, self.sums)
        return (x - whole).astype(np.float64) - rest / max(self.n, 1)

    def projected(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - sums)^2, exact; null where it is beyond a long."""
        if not x.size:
            return [0] * len(x)
        bound = (self.n * int(np.abs(x).max()) + int(np.abs(self.sums).max())) ** 2 * x.shape[1]
        if bound < 1 << 63:
            return ((self.n * x - self.sums) ** 2).sum(axis=1).tolist()
        exact = [sum((self.n * int(c) - int(s)) ** 2 for c, s in zip(row, self.sums)) for row in x]
        return [v if v < 1 << 63 else None for v in exact]


def fit(fixed: DataFrame, components: int) -> Whitening | None:
    """Whitening by the distinct vectors of the column x; None without any variance.

    Components whose variance is no more than rounding (a 10^-12th of the largest) can't be scaled to one and are left out.
    """
    rows = staged(fixed.select("x").distinct(), "fit-list")
    n, dims = rows.agg(F.count("*"), F.max(F.size("x"))).first()
    if not dims:
        return None
    if dims > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {dims} entries; the covariance is solved for {MOST_DIMENSIONS} at most")
    made = Whitening(n, _summed(rows, lambda x: x.sum(axis=0)[None], dims, "long")[0], np.zeros(0), np.zeros((dims, 0)), 0.0, 0.0)

    def products(x: np.ndarray) -> np.ndarray:
        y = made.centred(x)
        return y.T @ y

    covariance = _summed(rows, products, dims, "double") / n
    values, vectors = leading_eigenvectors((covariance + covariance.T) / 2, components)
    real = values > 1e-12 * max(values.max(initial=0.0), 0.0)
    if not real.any():
        return None
    made = Whitening(n, made.sums, values[real], vectors[:, real], float(np.trace(covariance)), 0.0)
    middle = _summed(rows, lambda x: made.projected(x).sum(axis=0)[None], dims, "double")[0] / n

    def spread(x: np.ndarray) -> np.ndarray:
        w = made.projected(x) - middle
        return w.T @ w

    made.identity_error = float(np.abs(_summed(rows, spread, dims, "double") / n - np.eye(len(made.values))).max())
    return made


def whitened(rows: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Per row and component, numbered from 1 by falling variance: vec_id, component, n (distinct vectors), deviation, whitened, explained, identity_error.

    Rows whose vector is null or has a null or non-finite entry go. Rows with a null or repeated id stay, each for itself. What a vector lacks of the longest
    one's entries counts as zero. Without two different vectors nothing can be whitened and there are no rows; a component without variance has none.
    Other columns are ignored, whatever their names.
    """
    fixed = rows.select(F.col(f"`{vec_id}`").alias("vec_id"), fixed_point(F.col(f"`{vector}`")).alias("x")).filter("x is not null")
    made = fit(fixed, components)
    schema = f"vec_id {fixed.schema['vec_id'].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if made is None:
        return rows.sparkSession.createDataFrame([], schema)
    k, dims = len(made.values), len(made.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column(1), dims)
            each = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(each), made.n)),
                pa.array(made.deviation(x), pa.int64()).take(pa.array(each)), pa.array(made.projected(x).ravel()), pa.array(np.tile(made.values / made.trace, len(x))),
                pa.array(np.full(len(each), made.identity_error)),
            ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return fixed.mapInArrow(run, schema)
