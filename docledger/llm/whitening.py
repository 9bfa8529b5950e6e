"""Whitening of embeddings: rotated and scaled so that all components are uncorrelated and of one variance.

Moments are gathered by Welford's update: every partition runs through its rows and updates a count, the mean and the
matrix of centred products by one row at a time.  States of partitions are merged by the parallel formula, in a tree of
groups of a bounded number of bytes, so neither a task nor the driver holds more than one group.  The eigenvectors come
from one symmetric matrix, whose size is the square of the vectors' length whatever the number of rows.

Scaled components are integers with a large common offset; the offset is taken off first, which no centred moment notices
and which leaves all digits to the differences.  Sums are exact integers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import delete, recording, saved
from .embeddings import floored, largest, matrix, usable, width_of

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
#: Bytes of states that are merged at once.
MERGE_BYTES = 32 << 20

STATE = "part long, n long, sums array<decimal(38,0)>, mean binary, products binary"


class Moments:
    """Count, exact sums, mean and matrix of centred products of the rows seen."""

    def __init__(self, width: int):
        self.n, self.sums = 0, np.zeros(width, object)
        self.mean, self.products = np.zeros(width), np.zeros((width, width))

    def add(self, rows: np.ndarray) -> None:
        """Rank-one updates, row by row."""
        mean, products, step = self.mean, self.products, np.empty_like(self.products)
        for row in rows:
            self.n += 1
            difference = row - mean
            mean += difference / self.n
            np.multiply.outer(difference, difference * ((self.n - 1) / self.n), out=step)
            products += step

    def merge(self, other: Moments) -> None:
        n = self.n + other.n
        if not other.n:
            return
        difference = other.mean - self.mean
        self.products += other.products + np.multiply.outer(difference, difference) * (self.n * other.n / n)
        self.mean += difference * (other.n / n)
        self.sums = self.sums + other.sums
        self.n = n

    def covariance(self) -> np.ndarray:
        """Divided by the number of rows."""
        return (self.products + self.products.T) / (2 * self.n)

    def row(self, part: int) -> pa.RecordBatch:
        sums = [Decimal(int(s)) for s in self.sums]
        return pa.record_batch(
            {"part": pa.array([part], pa.int64()), "n": pa.array([self.n], pa.int64()), "sums": pa.array([sums], pa.list_(pa.decimal128(38, 0))), "mean": pa.array([self.mean.tobytes()], pa.binary()), "products": pa.array([self.products.tobytes()], pa.binary())}
        )

    @classmethod
    def of(cls, rows: pa.Table | pa.RecordBatch, width: int) -> Moments:
        """All states of a table merged, in the order of their numbers."""
        out = cls(width)
        for r in sorted(rows.to_pylist(), key=lambda r: r["part"]):
            one = cls(width)
            one.n, one.sums = r["n"], np.array([int(s) for s in r["sums"]], object)
            one.mean, one.products = np.frombuffer(r["mean"]), np.frombuffer(r["products"]).reshape(width, width)
            out.merge(one)
        return out


def moments(vectors: DataFrame, width: int, values: Callable[[pa.Array], tuple[np.ndarray, np.ndarray | None]]) -> Moments:
    """Moments of all vectors. ``values`` turns a batch into rows of doubles and, if sums are wanted, rows of integers."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Moments(width)
        for batch in stream:
            rows, whole = values(batch.column("vector"))
            if whole is not None:
                exact = whole if largest(whole) * max(1, len(whole)) < 2**62 else whole.astype(object)
                state.sums = state.sums + exact.sum(0).astype(object)
            state.add(rows)
        if state.n:
            yield state.row(TaskContext.get().partitionId())

    fan = max(2, MERGE_BYTES // max(1, 8 * width * width))
    with recording() as made:
        states = saved(vectors.select("vector").mapInArrow(run, STATE), "moments")
    while states.count() > fan:
        before = made
        groups = states.select(F.floor(F.col("part") / fan).cast("long").alias("group"), "*").groupBy("group")
        with recording() as made:
            states = saved(groups.applyInArrow(lambda key, t: pa.Table.from_batches([Moments.of(t, width).row(key[0].as_py())]), STATE), "moments")
        delete(vectors.sparkSession, before)
    out = Moments.of(states.toArrow(), width)
    delete(vectors.sparkSession, made)
    return out


def symmetric_qr(matrix_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order and, in rows, unit eigenvectors whose largest entry is positive.

    Householder reflections make the matrix tridiagonal; QR steps with Wilkinson's shift, carried out as rotations that chase
    a bulge down, then drive its off-diagonal to zero from below.
    """
    a = np.array(matrix_, np.float64)
    n = len(a)
    vectors = np.eye(n)
    for k in range(n - 2):
        v = a[k + 1 :, k].copy()
        size = -np.copysign(np.linalg.norm(v), v[0])
        if size == 0:
            continue
        v[0] -= size
        v /= np.linalg.norm(v)
        image = a[k + 1 :, k + 1 :] @ v
        w = 2 * (image - (v @ image) * v)
        a[k + 1 :, k + 1 :] -= np.multiply.outer(v, w) + np.multiply.outer(w, v)
        a[k + 1, k] = a[k, k + 1] = size
        vectors[k + 1 :] -= 2 * np.multiply.outer(v, v @ vectors[k + 1 :])
    diagonal, beside = np.diag(a).copy(), np.diag(a, 1).copy()
    eps, high = np.finfo(float).eps, n - 1
    while high > 0:
        beside[np.abs(beside) <= eps * (np.abs(diagonal[:-1]) + np.abs(diagonal[1:]))] = 0
        if beside[high - 1] == 0:
            high -= 1
            continue
        low = high - 1
        while low > 0 and beside[low - 1] != 0:
            low -= 1
        half, corner = (diagonal[high - 1] - diagonal[high]) / 2, beside[high - 1]
        shift = diagonal[high] - corner * (corner / (half + np.copysign(np.hypot(half, corner), half)))
        x, z = diagonal[low] - shift, beside[low]
        for k in range(low, high):
            r = np.hypot(x, z)
            c, s = (x / r, z / r) if r else (1.0, 0.0)
            if k > low:
                beside[k - 1] = r
            p, q, t = diagonal[k], diagonal[k + 1], beside[k]
            diagonal[k], diagonal[k + 1] = c * c * p + 2 * c * s * t + s * s * q, s * s * p - 2 * c * s * t + c * c * q
            beside[k] = x = c * s * (q - p) + (c * c - s * s) * t
            if k < high - 1:
                z, beside[k + 1] = s * beside[k + 1], c * beside[k + 1]
            vectors[k], vectors[k + 1] = c * vectors[k] + s * vectors[k + 1], c * vectors[k + 1] - s * vectors[k]
    order = np.argsort(-diagonal, kind="stable")
    values, vectors = diagonal[order], vectors[order]
    signs = np.sign(vectors[np.arange(n), np.abs(vectors).argmax(1)])
    return values, vectors * signs[:, None]


class Whitening:
    """What whitens a vector: exact mean, components, and which of them have variance."""

    def __init__(self, state: Moments, most: int):
        self.n, self.sums = state.n, [int(s) for s in state.sums]
        covariance = state.covariance()
        values, vectors = symmetric_qr(covariance)
        self.values, self.vectors = values[:most], vectors[:most]
        self.trace = float(np.trace(covariance))
        #: Below this an eigenvalue is rounding.
        floor = max(values.max(initial=0), 0) * len(values) * np.finfo(float).eps * 8
        self.varies = self.values > floor
        self.whole = np.array([s // self.n for s in self.sums], np.int64)
        self.rest = [s % self.n for s in self.sums]

    def _centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n; the whole part of the mean is taken off as integers."""
        return (x - self.whole) - np.array([r / self.n for r in self.rest])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """NaN in components without variance."""
        scale = np.sqrt(np.where(self.varies, self.values, np.nan))
        return self._centred(x) @ self.vectors.T / scale

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """The sum over dimensions of (n*x - S)**2, exact; null beyond a long."""
        z = x - self.whole
        most = largest(z) + 1
        rest = np.array(self.rest, np.int64)
        if x.shape[1] * most * max(most, self.n) >= 2**62:
            z, rest = z.astype(object), rest.astype(object)
        squares, across = (z * z).sum(1).astype(object), (z * rest).sum(1).astype(object)
        found = self.n * (self.n * squares - 2 * across) + sum(r * r for r in self.rest)
        return [int(v) if v < 2**63 else None for v in found]


def fit(vectors: DataFrame, width: int, most: int = COMPONENTS) -> Whitening:
    """Fitted to all rows of ``vectors`` (column vector)."""

    def values(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        x = floored(matrix(column, width), SCALE)
        return x.astype(np.float64), x + OFFSET

    state = moments(vectors, width, values)
    return Whitening(state, most)


def whiten(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error for each usable row and component.

    Rows whose vector is null or holds null, NaN or infinity are left out, and not fitted to.  Vectors of unequal length count as
    if zeros followed; scaled entries beyond 2**52 count as that.  A component without variance (fewer vectors than dimensions,
    constant dimensions) has a null whitened value, and identity_error, measured over all whitened rows, leaves it out.
    A deviation beyond a long is null.  Null and repeated vec_ids are rows like others; an empty table gives no rows.  Other columns
    are not read.
    """
    vectors = usable(rows, vector, F.col(f"`{vec_id}`").cast("long").alias("vec_id"))
    width = width_of(vectors)
    schema = "vec_id long, deviation long, whitened array<double>"
    if not width:
        one = vectors.where(F.lit(False)).select("vec_id", F.lit(None).cast("long").alias("deviation"), F.array().cast("array<double>").alias("whitened"))
        return _unfolded(one, 0, np.zeros(0), 0.0)
    model = fit(vectors, width, most)
    varies = np.flatnonzero(model.varies)

    def checked(column: pa.Array) -> tuple[np.ndarray, None]:
        return model.whitened(floored(matrix(column, width), SCALE) + OFFSET)[:, varies], None

    error = float(np.abs(moments(vectors, len(varies), checked).covariance() - np.eye(len(varies))).max(initial=0)) if len(varies) else 0.0

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            x = floored(matrix(batch.column("vector"), width), SCALE) + OFFSET
            found = model.whitened(x)
            flat = pa.array(found.ravel(), pa.float64(), mask=np.isnan(found).ravel())
            listed = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * found.shape[1], pa.int32()), flat)
            yield pa.record_batch({"vec_id": batch.column("vec_id"), "deviation": pa.array(model.deviation(x), pa.int64()), "whitened": listed})

    explained = np.maximum(model.values, 0) / model.trace if model.trace else np.zeros(len(model.values))
    return _unfolded(vectors.mapInArrow(run, schema), model.n, explained, error)


def _unfolded(rows: DataFrame, n: int, explained: np.ndarray, error: float) -> DataFrame:
    """One row for each vector and component."""
    flat = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    share = F.array(*(F.lit(float(e)) for e in explained)).cast("array<double>")
    return flat.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened", F.get(share, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error")
    )
