"""Embedding whitening: distributed covariance, its leading eigenvectors, projection of every row."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import drop_path, work_path

_EPS = float(np.finfo(float).eps)
#: Whole numbers up to this size are exact in double precision and safe to add up in a long.
_SAFE = float(1 << 53)
_LONG = (1 << 63) - 1

# --- eigenvectors of a symmetric matrix


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """Diagonal and off-diagonal of ``Q' matrix Q``, and the reflections that make up Q (Householder)."""
    a = np.array(matrix, float)
    size = len(a)
    reflections = []
    for k in range(size - 2):
        v = a[k + 1 :, k].copy()
        length = np.linalg.norm(v)
        if length == 0:
            continue
        turned = -np.copysign(length, v[0])
        v[0] -= turned
        v /= np.linalg.norm(v)
        reflections.append((k + 1, v))
        # (I - 2vv') A (I - 2vv') on the rest, as one update of rank two.
        rest = a[k + 1 :, k + 1 :]
        p = 2 * (rest @ v)
        w = p - (v @ p) * v
        rest -= np.outer(v, w) + np.outer(w, v)
        a[k + 1 :, k] = a[k, k + 1 :] = 0
        a[k + 1, k] = a[k, k + 1] = turned
    return np.diag(a).copy(), np.diag(a, 1).copy(), reflections


def below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each point of ``at`` how many eigenvalues are smaller: the negative pivots of a Sturm sequence."""
    tiny = _EPS * max(np.abs(diagonal).max(), np.abs(off).max(initial=0), np.finfo(float).tiny / _EPS)
    pivot = diagonal[0] - at
    count = (pivot < 0).astype(int)
    for i in range(1, len(diagonal)):
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        pivot = diagonal[i] - at - off[i - 1] ** 2 / pivot
        count += pivot < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` largest eigenvalues, falling, by bisection of all at once on Sturm counts."""
    size = len(diagonal)
    reach = np.abs(np.append(off, 0)) + np.abs(np.append(0, off))
    low = np.full(count, (diagonal - reach).min())
    high = np.full(count, (diagonal + reach).max())
    spread = max(abs(low[0]), abs(high[0]))
    low, high = low - _EPS * spread, high + _EPS * spread
    wanted = size - 1 - np.arange(count)  # so many eigenvalues are smaller than the k-th largest
    while True:
        middle = (low + high) / 2
        if np.all((middle <= low) | (middle >= high) | (high - low <= 2 * _EPS * np.maximum(np.abs(low), np.abs(high)))):
            return middle
        small = below(diagonal, off, middle) <= wanted
        low, high = np.where(small, middle, low), np.where(small, high, middle)


def _solver(diagonal: np.ndarray, off: np.ndarray, shift: float, floor: float):
    """Solves ``(T - shift) x = b`` by elimination with row exchanges; vanishing pivots become ``floor``."""
    size = len(diagonal)
    # Rows of the upper factor hold three diagonals; the multipliers and exchanges are kept.
    u = np.zeros((size, 3))
    u[:, 0] = diagonal - shift
    u[:-1, 1] = off
    factor, swapped = np.zeros(size), np.zeros(size, bool)
    for i in range(size - 1):
        below_ = np.array([off[i], diagonal[i + 1] - shift, off[i + 1] if i + 2 < size else 0.0])
        if abs(below_[0]) > abs(u[i, 0]):
            swapped[i] = True
            u[i], below_ = below_, u[i].copy()
        if u[i, 0] == 0:
            u[i, 0] = floor
        factor[i] = below_[0] / u[i, 0]
        u[i + 1, 0] = below_[1] - factor[i] * u[i, 1]
        u[i + 1, 1] = below_[2] - factor[i] * u[i, 2]
    pivots = np.where(np.abs(u[:, 0]) < floor, np.copysign(floor, u[:, 0]), u[:, 0])

    def solve(b: np.ndarray) -> np.ndarray:
        x = b.copy()
        for i in range(size - 1):
            if swapped[i]:
                x[i], x[i + 1] = x[i + 1], x[i]
            x[i + 1] -= factor[i] * x[i]
        for i in range(size - 1, -1, -1):
            ahead = (u[i, 1] * x[i + 1] if i + 1 < size else 0.0) + (u[i, 2] * x[i + 2] if i + 2 < size else 0.0)
            x[i] = (x[i] - ahead) / pivots[i]
        return x

    return solve


def leading_vectors(matrix: np.ndarray, count: int, seed: int = 13) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns.

    Householder reflections make the matrix tridiagonal, Sturm counts bisect
    its eigenvalues, and inverse iteration finds a vector for each.  Vectors of
    eigenvalues that lie within a thousandth of the largest are made orthogonal
    to one another in every step, as nearly equal ones would otherwise give the
    same vector.
    """
    matrix = np.asarray(matrix, float)
    count = min(count, len(matrix))
    scale = np.abs(matrix).max(initial=0)
    if not count or scale == 0:
        return np.zeros(count), np.eye(len(matrix))[:, :count]
    diagonal, off, reflections = tridiagonal(matrix / scale)
    values = leading_values(diagonal, off, count)
    largest = max(np.abs(diagonal).max(), np.abs(off).max(initial=0))
    draw = np.random.default_rng(seed)
    vectors = np.zeros((len(matrix), count))
    for k in range(count):
        start = k
        while start and values[start - 1] - values[k] <= 1e-3 * largest:
            start -= 1
        cluster = vectors[:, start:k]
        # Equal eigenvalues get slightly different shifts.
        solve = _solver(diagonal, off, values[k] - 4 * _EPS * largest * (k - start), _EPS * largest)
        x = draw.normal(size=len(matrix))
        for _ in range(6):
            x -= cluster @ (cluster.T @ x)
            x = solve(x / np.linalg.norm(x))
            x /= np.abs(x).max()
        for _ in range(2):
            x -= cluster @ (cluster.T @ x)
            x /= np.linalg.norm(x)
        vectors[:, k] = x
    for first, v in reversed(reflections):
        vectors[first:] -= 2 * np.outer(v, v @ vectors[first:])
    return values * scale, vectors


# --- on DataFrames


def whole(vec: str, scale: int = 64, offset: int = 1_000_000) -> Column:
    """The entries as whole numbers ``floor(scale * c) + offset``; null where the vector cannot be used.

    That is if it is null, empty or holds an entry that is null, not finite or
    beyond a long.
    """
    good = lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float(1 << 62) / scale)  # noqa: E731  NaN is above
    listed = F.transform(vec, lambda c: F.floor(c.cast("double") * scale) + F.lit(offset).cast("long"))
    return F.when((F.size(vec) > 0) & F.forall(vec, good), listed)


@dataclass(frozen=True)
class Fit:
    """What the fit list says: its rows, sums per dimension, leading eigenvalues and vectors, trace, identity error."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - S / n`` in double precision, the difference taken in whole numbers."""
        return self.moved(x).astype(float) / self.n

    def moved(self, x: np.ndarray) -> np.ndarray:
        """``n * x - S``, exact: longs where they suffice, Python's numbers otherwise."""
        sums = np.array(self.sums, object)
        if self.n * float(np.abs(x.astype(float)).max(initial=1)) < _SAFE and max(map(abs, self.sums)) < _SAFE:
            return self.n * x - sums.astype(np.int64)
        return self.n * x.astype(object) - sums

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum over the dimensions of ``(n * x - S) ** 2``, exact; null beyond a long."""
        moved = self.moved(x)
        if moved.dtype != object and float(np.abs(moved).max(initial=0)) ** 2 * max(1, moved.shape[1]) < _SAFE:
            return (moved * moved).sum(1).tolist()
        return [d if d <= _LONG else None for d in (sum(int(m) * int(m) for m in row) for row in moved)]


def _matrix(column: pa.ListArray, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _entries(name: str, fitted: DataFrame, size: int, width: int, made) -> np.ndarray:
    """The sum over all tasks of ``made(x)``, an array of ``width`` numbers for the rows of a batch."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for part in range(0, batch.num_rows, 4096):
                x = _matrix(batch.column("x").slice(part, 4096), size)
                total = made(x) if total is None else total + made(x)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(total.ravel())], names=["at", name])

    # One row per entry and task; Spark adds them up before and after the shuffle.
    rows = fitted.mapInArrow(run, f"at long, {name} double").groupBy("at").agg(F.sum(name).alias(name)).collect()
    out = np.zeros(width)
    for row in rows:
        out[row["at"]] = row[name]
    return out


def fit(fitted: DataFrame, size: int, components: int = 16) -> Fit | None:
    """Sums, covariance and leading components of the whole-number vectors ``x`` of ``fitted``, all of length ``size``.

    Three passes: sums per dimension, products of centred entries, and products
    of whitened entries.  Every task adds up its own rows; what is shuffled and
    collected has the square of the dimension, not the number of rows.
    """
    exact = [F.sum(F.col("x")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(size)]
    counted = fitted.agg(F.count("*").alias("n"), *exact).first()
    if not counted["n"]:
        return None
    sums = tuple(int(counted[f"s{i}"]) for i in range(size))
    bare = Fit(counted["n"], sums, np.zeros(0), np.zeros((size, 0)), 0.0)

    def products(x: np.ndarray) -> np.ndarray:
        moved = bare.centred(x)
        return (moved.T @ moved).ravel()

    covariance = _entries("v", fitted, size, size * size, products).reshape(size, size) / bare.n
    covariance = (covariance + covariance.T) / 2
    values, vectors = leading_vectors(covariance, components)
    trace = float(np.trace(covariance))
    # Beyond rounding only: a direction without variance cannot be scaled to one.
    kept = values > 8 * size * _EPS * max(trace, 0.0)
    model = Fit(bare.n, sums, values[kept], vectors[:, kept], trace)
    found = int(kept.sum())

    def identity(x: np.ndarray) -> np.ndarray:
        made = model.whitened(x)
        return (made.T @ made).ravel()

    if not found:
        return model
    error = np.abs(_entries("v", fitted, size, found * found, identity).reshape(found, found) / model.n - np.eye(found)).max()
    return Fit(model.n, sums, model.values, model.vectors, trace, float(error))


def whiten(vectors: DataFrame, components: int = 16, vec_id: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """Up to ``components`` rows per usable row of ``vectors``.

    Returns vec_id, component, n, deviation, whitened, explained and
    identity_error.  The entries become whole numbers x (see ``whole``).  The
    fit list holds every different x once; n is its length, S its sums.
    Components are the leading unit eigenvectors of its covariance (divisor n),
    numbered from 1 by falling eigenvalue e.  ``whitened`` is x - S/n on the
    component over the root of e, ``explained`` e over the trace,
    ``deviation`` the exact sum of (n * x - S) ** 2, null where a long cannot
    hold it, and ``identity_error`` the largest absolute entry of the whitened fit
    list's covariance minus the identity, measured.

    Rows whose vector is null, empty or holds an entry that is null, not finite
    or beyond a long are dropped, and so are vectors of another length than the
    most frequent one (of equals the longest).  Directions without variance
    have no component: one different vector alone, or an empty table, gives an
    empty result.  Repeated rows and null ids are rows; other columns are
    ignored.

    The fit list is one shuffle by x, in which every task has dropped its own
    copies, and is written to the shared folder, where small whole numbers take
    a few bits.  The matrix of d x d entries is worked on by the driver; the
    components (d x ``components`` numbers) go out with the tasks.
    """
    spark = vectors.sparkSession
    light = vectors.select(F.col(vec_id).alias("vec_id"), whole(vec).alias("x")).where(F.col("x").isNotNull())
    path = work_path(spark, "whitening")
    light.select("x").dropDuplicates(["x"]).write.parquet(path)
    listed = spark.read.parquet(path)
    lengths = light.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    size = lengths["size"] if lengths else 0
    model = fit(listed.where(F.size("x") == size), size, components) if size else None
    drop_path(spark, path)
    kind = vectors.schema[vec_id].dataType
    fields = [("component", T.IntegerType()), ("n", T.LongType()), ("deviation", T.LongType())]
    fields += [(c, T.DoubleType()) for c in ("whitened", "explained", "identity_error")]
    schema = T.StructType([T.StructField(vec_id, kind), *[T.StructField(*f) for f in fields]])
    found = 0 if model is None else len(model.values)
    if not found:
        return spark.createDataFrame([], schema)
    explained = model.values / model.trace

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, 4096):
                some = batch.slice(part, 4096)
                x = _matrix(some.column("x"), size)
                rows = len(x)
                repeat = np.repeat(np.arange(rows), found)
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column("vec_id").take(pa.array(repeat)),
                        pa.array(np.tile(np.arange(1, found + 1, dtype=np.int32), rows)),
                        pa.array(np.full(rows * found, model.n)),
                        pa.array(model.deviations(x), pa.int64()).take(pa.array(repeat)),
                        pa.array(model.whitened(x).ravel()),
                        pa.array(np.tile(explained, rows)),
                        pa.array(np.full(rows * found, model.identity_error)),
                    ],
                    names=schema.names,
                )

    return light.where(F.size("x") == size).mapInArrow(run, schema)
