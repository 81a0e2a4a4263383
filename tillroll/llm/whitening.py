"""Whitening of embedding vectors by their leading principal components.

Entries are put on an integer grid, so counts and sums over the table are exact.  The covariance is summed
task by task from centred vectors.  Its leading eigenpairs come from the tridiagonal form: Householder reflections
reduce the matrix, Sturm counts bisect the leading eigenvalues, and inverse iteration finds their vectors, those of
close eigenvalues being made orthogonal to each other.  The projection is broadcast and applied to every row.

The driver holds one matrix of dimensions x dimensions, at most ``MAX_DIMENSIONS`` squared numbers.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

COMPONENTS = 32
SCALE = 64
SHIFT = 1_000_000
#: Longer vectors are refused: the covariance would not fit a driver.
MAX_DIMENSIONS = 4096
#: Components whose eigenvalue is below this share of the largest have no direction of their own and are left out.
LEAST_SHARE = 1e-12
#: Partial sums meet in groups of this many tasks first.
FAN_IN = 64


def householder(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, off-diagonal, reflectors) of the tridiagonal form of a symmetric matrix."""
    a = a.copy()
    d = len(a)
    reflectors = []
    for k in range(d - 2):
        x = a[k + 1:, k]
        size = np.linalg.norm(x)
        v = x.copy()
        v[0] += np.copysign(size, x[0])
        norm = np.linalg.norm(v)
        v = v / norm if norm > 0 and np.linalg.norm(x[1:]) > 0 else np.zeros_like(v)
        reflectors.append(v)
        if v.any():
            rest = a[k + 1:, k + 1:]
            p = 2 * (rest @ v)
            w = p - (p @ v) * v
            rest -= np.outer(v, w) + np.outer(w, v)
            column = x - 2 * (v @ x) * v
            a[k + 1:, k] = column
            a[k, k + 1:] = column
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def sturm_count(diagonal: np.ndarray, off: np.ndarray, x: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each of ``x``: negative pivots of the shifted matrix."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    q = diagonal[0] - x
    below = (q < 0).astype(int)
    for i in range(1, len(diagonal)):
        q = np.where(np.abs(q) < tiny, -tiny, q)
        q = diagonal[i] - x - off[i - 1] ** 2 / q
        below += q < 0
    return below


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, by bisection to the last bit."""
    reach = np.r_[0.0, np.abs(off)] + np.r_[np.abs(off), 0.0]
    low, high = (diagonal - reach).min(), (diagonal + reach).max()
    slack = np.finfo(float).eps * max(abs(low), abs(high), np.finfo(float).tiny) * len(diagonal)
    lo, hi = np.full(k, low - slack), np.full(k, high + slack)
    place = len(diagonal) - 1 - np.arange(k)  # the eigenvalue with so many below it
    while True:
        mid = lo + (hi - lo) / 2
        if ((mid <= lo) | (mid >= hi)).all():
            return mid
        under = sturm_count(diagonal, off, mid) <= place
        lo, hi = np.where(under, mid, lo), np.where(under, hi, mid)


def _solve(diagonal: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray) -> np.ndarray:
    """(T - shift) x = b by elimination with row exchanges; vanishing pivots are replaced by tiny ones."""
    n = len(diagonal)
    least = np.finfo(float).eps * max(np.abs(diagonal).max(), np.abs(off).max(initial=0), np.finfo(float).tiny)
    u0, u1, u2, y = np.empty(n), np.zeros(n), np.zeros(n), b.copy()
    p, q = diagonal[0] - shift, off[0] if n > 1 else 0.0  # the row that is left over: its first two entries
    for i in range(n - 1):
        below, next_, after = off[i], diagonal[i + 1] - shift, off[i + 1] if i + 2 < n else 0.0
        if abs(p) >= abs(below):
            pivot = p if abs(p) > least else np.copysign(least, p)
            f = below / pivot
            u0[i], u1[i], u2[i] = pivot, q, 0.0
            p, q = next_ - f * q, after
            y[i + 1] -= f * y[i]
        else:
            f = p / below
            u0[i], u1[i], u2[i] = below, next_, after
            p, q = q - f * next_, -f * after
            y[i], y[i + 1] = y[i + 1], y[i] - f * y[i + 1]
    u0[n - 1] = p if abs(p) > least else np.copysign(least, p)
    x = np.empty(n)
    for i in range(n - 1, -1, -1):
        x[i] = (y[i] - (u1[i] * x[i + 1] if i + 1 < n else 0.0) - (u2[i] * x[i + 2] if i + 2 < n else 0.0)) / u0[i]
    return x


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, rounds: int = 4, seed: int = 3) -> np.ndarray:
    """Unit eigenvectors (columns) of the tridiagonal matrix.  Eigenvalues closer than a thousandth of its size form a
    cluster: their shifts are kept apart, and their vectors are made orthogonal in every round."""
    n, k = len(diagonal), len(values)
    size = max(np.abs(diagonal).max() + 2 * np.abs(off).max(initial=0), np.finfo(float).tiny)
    rng = np.random.default_rng(seed)
    out = np.empty((n, k))
    first, shift = 0, np.inf
    for j in range(k):
        if j and values[j - 1] - values[j] > 1e-3 * size:
            first = j
        shift = min(values[j], shift - 4 * np.finfo(float).eps * size) if j > first else values[j]
        x = rng.standard_normal(n)
        for _ in range(rounds):
            x = _solve(diagonal, off, shift, x / np.linalg.norm(x))
            x /= np.abs(x).max()
            for _ in range(2):
                x -= out[:, first:j] @ (out[:, first:j].T @ x)
        out[:, j] = x / np.linalg.norm(x)
    return out


def leading_components(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` leading eigenvalues and unit eigenvectors (columns) of a symmetric matrix."""
    diagonal, off, reflectors = householder(a)
    values = leading_eigenvalues(diagonal, off, min(k, len(a)))
    vectors = inverse_iteration(diagonal, off, values)
    for i in range(len(reflectors) - 1, -1, -1):
        v = reflectors[i]
        vectors[i + 1:] -= 2 * np.outer(v, v @ vectors[i + 1:])
    return values, vectors


def _grid(column: pa.Array, scale: int, shift: int) -> np.ndarray:
    """Vectors of one length as rows of integers."""
    c = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    return np.floor(scale * c).astype(np.int64) + shift


def _summed(partials: DataFrame, n: int) -> list[np.ndarray]:
    """Sums of the rows (i, values) over all tasks: first of groups of tasks, then of the groups.  ``n`` rows."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        groups: dict[int, int] = {}
        for b in batches:
            for g, i, values in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                v = values.values.to_numpy(zero_copy_only=False)
                sums[i] = sums[i] + v if i in sums else v.copy()
                groups[i] = g
        yield pa.RecordBatch.from_arrays(
            [pa.array([groups[i] for i in sums], pa.int32()), pa.array(list(sums), pa.int32()),
             pa.array([sums[i] for i in sums], partial_type)], ["g", "i", "v"])

    kind = partials.schema["v"].dataType.simpleString()
    partial_type = pa.list_(pa.int64() if "bigint" in kind else pa.float64())
    schema = f"g int, i int, v {kind}"
    parts = int(partials.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    once = partials.select(F.pmod(F.spark_partition_id(), F.lit(FAN_IN)).alias("g"), "i", "v").repartition(parts, "g", "i").mapInArrow(add, schema)
    twice = once.repartition(min(parts, n), "i").mapInArrow(add, schema)
    out = {r["i"]: np.array(r["v"]) for r in twice.collect()}  # n rows
    return [out[i] for i in range(n)] if len(out) == n else []


def _moments(scale: int, shift: int):
    """Per task: row 0, the number of vectors and their sums by dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = None, 0
        for b in batches:
            if b.num_rows:
                x = _grid(b.column(0), scale, shift).sum(axis=0)
                total, n = x if total is None else total + x, n + b.num_rows
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([[n, *total.tolist()]], pa.list_(pa.int64()))], ["i", "v"])
    return run


def _gram(rows_of, d: int):
    """Per task: the sum of outer products of the centred rows that ``rows_of`` makes of a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((d, d)), False
        for b in batches:
            if b.num_rows:
                y = rows_of(b.column(0))
                total += y.T @ y
                seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)),
                                              pa.array(list(total), pa.list_(pa.float64()))], ["i", "v"])
    return run


def _centred(scale: int, shift: int, n: int, sums: np.ndarray):
    """x - S / n of the vectors of a batch: the whole part of the mean is taken off exactly first."""
    whole, rest = np.array([int(s) // n for s in sums]), np.array([int(s) % n / n for s in sums])
    return lambda column: (_grid(column, scale, shift) - whole) - rest


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """sum over dimensions of (n x - S) ** 2, exact; null beyond 64 bits."""
    y = x * n - sums  # |x - S / n| is small on the grid, so this fits where the square does
    most = int(np.abs(y).max(initial=0))
    if most * most * y.shape[1] < 1 << 63:
        return (y * y).sum(axis=1).tolist()
    exact = [sum(v * v for v in row) for row in y.tolist()]
    return [v if v < 1 << 63 else None for v in exact]


def _whitened(whitener, scale: int, shift: int, n: int, sums: np.ndarray, explained: np.ndarray, error: float):
    """(vec_id, vector) to a row for each component."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, centred, k = whitener.value, _centred(scale, shift, n, sums), len(explained)
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                rows = part.num_rows
                which = pa.array(np.repeat(np.arange(rows), k))
                values = centred(part.column(1)) @ w
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(which), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                     pa.array(np.full(rows * k, n)), pa.array(_deviations(_grid(part.column(1), scale, shift), n, sums), pa.int64()).take(which),
                     pa.array(values.ravel()), pa.array(np.tile(explained, rows)), pa.array(np.full(rows * k, error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """One row per vector and component: (vec_id, component, n, deviation, whitened, explained, identity_error).

    Vectors that are null or hold null or non-finite entries are dropped, empty ones have no components.  Vectors of
    different lengths do not share a space: each length is fitted and whitened by itself.  Components without variance
    (an eigenvalue below ``LEAST_SHARE`` of the largest) are left out, so equal vectors, or one vector, have no
    rows.  Repeated rows and null ids are vectors like others.  ``deviation`` is null where it does not fit 64 bits.
    Lengths above ``MAX_DIMENSIONS`` raise.  Columns other than the two named are not read.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[vec_id].dataType.simpleString()
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("e"))
    finite = F.forall("e", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows.where(F.coalesce(finite, F.lit(False)) & (F.size("e") > 0))
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    out = spark.createDataFrame([], schema)
    lengths = sorted(r[0] for r in rows.select(F.size("e")).distinct().limit(MAX_DIMENSIONS + 1).collect())
    if lengths and lengths[-1] > MAX_DIMENSIONS:
        raise ValueError(f"vectors of more than {MAX_DIMENSIONS} entries")
    for d in lengths:
        mine = rows if len(lengths) == 1 else rows.where(F.size("e") == d)
        only = mine.select("e")
        moments = _summed(only.mapInArrow(_moments(scale, shift), "i int, v array<bigint>"), 1)[0]
        n, sums = int(moments[0]), moments[1:]
        centred = _centred(scale, shift, n, sums)
        gram = _summed(only.mapInArrow(_gram(centred, d), "i int, v array<double>"), d)
        covariance = np.array(gram) / n
        if np.trace(covariance) <= 0:
            continue
        values, axes = leading_components((covariance + covariance.T) / 2, components)
        kept = values > LEAST_SHARE * values[0]
        values, axes = values[kept], axes[:, kept]
        matrix = axes / np.sqrt(values)
        whitener = spark.sparkContext.broadcast(matrix)  # at most MAX_DIMENSIONS x components numbers
        white = _summed(only.mapInArrow(_gram(lambda column: centred(column) @ whitener.value, len(values)),
                                        "i int, v array<double>"), len(values))
        error = float(np.abs(np.array(white) / n - np.eye(len(values))).max())
        out = out.unionByName(mine.mapInArrow(
            _whitened(whitener, scale, shift, n, sums, values / np.trace(covariance), error), schema))
    return out
