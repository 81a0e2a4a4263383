"""k-means over many configurations at once.

A configuration is a table of vectors, a number of clusters, a seed and, for resampling, a column of weights.  Every
round is one pass over the rows: each row is assigned under every open configuration, and the tasks give back sums by
(configuration, cluster), so the data are read as often as the slowest configuration has rounds, not as often as
there are fits.  Converged configurations drop out.  The driver keeps the centres.

First centres are drawn by k-means++ from at most about ``START_ROWS`` rows, chosen by hash; all other work covers
every row.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Hashable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

START_ROWS = 5_000
#: Cells of rows x centres that are compared at once.
CELLS = 1 << 21
#: Sums of so many (task, centre) pairs at most are added up by the driver, more of them by a shuffle in between.
GATHERED = 1 << 18


@dataclass(frozen=True)
class Run:
    key: Hashable
    table: str
    k: int
    seed: int
    weight: int | None = None  # place in the weights column


@dataclass
class Fit:
    run: Run
    centres: np.ndarray
    cost: float = np.inf
    open: bool = field(default=True, repr=False)

    def cluster(self, x: Column) -> Column:
        """The nearest centre of an array column, the first of equally near ones."""
        far = [F.aggregate(F.zip_with(x, F.array(*map(F.lit, c)), lambda a, b: (a - b) * (a - b)), F.lit(0.0),
                           lambda s, v: s + v) for c in self.centres.tolist()]
        return (F.array_position(F.array(*far), F.least(*far) if len(far) > 1 else far[0]) - 1).cast("int")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


@contextmanager
def _spread(df: DataFrame, n: int, width: int) -> Iterator[DataFrame]:
    """The ``n`` rows over enough tasks for their cells, up to two for each core; ``df`` itself if it has as many.

    A table of vectors is small beside the work on it: as it was written it may lie in one partition."""
    parts = min(-(-n * width // CELLS), 2 * df.sparkSession.sparkContext.defaultParallelism)
    if df.rdd.getNumPartitions() >= parts:
        yield df
        return
    rows = df.repartition(parts).cache()
    try:
        yield rows
    finally:
        rows.unpersist()


def _sums(df: DataFrame, tables: Sequence[str], weights: str | None, width: int,
          work: Callable[[dict, np.ndarray | None], Iterable[tuple[int, np.ndarray]]]) -> dict[int, np.ndarray]:
    """``work`` on the rows of each task, a few at a time: (configuration, values), summed by place over all rows."""
    columns = [*tables, *([weights] if weights else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        step = max(1, CELLS // max(1, width))
        for b in batches:
            for at in range(0, b.num_rows, step):
                part = b.slice(at, step)
                xs = {t: _matrix(part.column(i)) for i, t in enumerate(tables)}
                for config, values in work(xs, _matrix(part.column(len(tables))) if weights else None):
                    total[config] = total[config] + values if config in total else values
        if few:  # a row for each configuration
            yield pa.RecordBatch.from_arrays(
                [pa.array([*total], pa.int32()), pa.array([v.astype(float).tobytes() for v in total.values()], pa.binary())],
                ["config", "value"])
            return
        for config, values in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(values), config, np.int32)), pa.array(np.arange(len(values), dtype=np.int32)),
                 pa.array(values.astype(float))], ["config", "slot", "value"])

    few = df.rdd.getNumPartitions() * width <= GATHERED
    if few:
        out: dict[int, np.ndarray] = {}
        for r in df.select(*columns).mapInArrow(run, "config int, value binary").collect():  # in the order of the tasks
            values = np.frombuffer(r["value"])
            out[r["config"]] = out[r["config"]] + values if r["config"] in out else values
        return out
    found = df.select(*columns).mapInArrow(run, "config int, slot int, value double") \
        .groupBy("config", "slot").agg(F.sum("value").alias("value")).collect()
    lists: dict[int, list[float]] = {}
    for r in sorted(found):  # a few numbers for each configuration and cluster
        lists.setdefault(r["config"], []).append(r["value"])
    return {c: np.array(v) for c, v in lists.items()}


def _distances(xs: dict, fits: dict[int, Fit]):
    """(configuration, its squared distances clusters x rows), one product for each table."""
    for table, x in xs.items():
        mine = [(c, f) for c, f in fits.items() if f.run.table == table]
        if not mine:
            continue
        stacked = np.concatenate([f.centres for _, f in mine])
        d = stacked @ x.T
        d *= -2
        d += (x * x).sum(axis=1)
        d += (stacked * stacked).sum(axis=1)[:, None]
        at = 0
        for c, f in mine:
            yield c, f, x, d[at:at + f.run.k]
            at += f.run.k


def _shares(d: np.ndarray) -> np.ndarray:
    """Clusters x rows: 1 at the nearest cluster of each row, the first of equally near ones."""
    share = (d <= d.min(axis=0)).astype(float)
    if share.sum() != d.shape[1]:
        again = np.flatnonzero(share.sum(axis=0) != 1)
        share[:, again] = 0
        share[d[:, again].argmin(axis=0), again] = 1
    return share


def _plus_plus(x: np.ndarray, w: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """First centres by greedy k-means++ with row weights: of a few draws the one that lowers the cost most.  Repeats the
    last centre where fewer distinct rows have weight."""
    w = w if w.sum() > 0 else np.ones(len(x))
    centres = [x[rng.choice(len(x), p=w / w.sum())]]
    far = ((x - centres[0]) ** 2).sum(axis=1)
    while len(centres) < k:
        p = w * far
        if p.sum() <= 0:
            centres.append(centres[-1])
            continue
        drawn = x[rng.choice(len(x), size=2 + int(np.log(k)), p=p / p.sum())]
        left = np.minimum(far, ((x - drawn[:, None]) ** 2).sum(axis=2))
        best = int((left @ w).argmin())
        centres.append(drawn[best])
        far = left[best]
    return np.array(centres)


def fit_all(df: DataFrame, runs: Sequence[Run], weights: str | None = None, max_iter: int = 300, tol: float = 1e-4) -> list[Fit]:
    """A fit of every run; ``df`` has an array column for each table, and is read once a round: pass a materialised one.

    A cluster without rows keeps its centre.  A run ends when no centre moves further than ``tol``; its cost is the
    weighted sum of squared distances to the centres it returns.  No rows raise ``ValueError``.
    """
    tables = sorted({r.table for r in runs})
    width = sum(r.k for r in runs)
    n = df.count()
    sample = df.select(*tables, *([weights] if weights else []))
    if n > START_ROWS:
        sample = sample.where(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n)) < START_ROWS)
    rows = sample.collect()  # about START_ROWS
    if not rows:
        raise ValueError("no rows to cluster")
    start = {t: np.array([r[t] for r in rows], float) for t in tables}
    drawn = np.array([r[weights] for r in rows], float) if weights else None
    fits = [Fit(r, _plus_plus(start[r.table], np.ones(len(rows)) if r.weight is None else drawn[:, r.weight], r.k,
                              np.random.default_rng([r.seed, r.k]))) for r in runs]
    with _spread(df.select(*sample.columns), n, width) as spread:
        _move(spread, fits, tables, weights, width, max_iter, tol)
    return fits


def _move(df: DataFrame, fits: list[Fit], tables: Sequence[str], weights: str | None, width: int, max_iter: int, tol: float) -> None:
    """Rounds until every fit has its centres and their cost."""
    settled: set[int] = set()  # centres are final, the cost is still to be counted
    for step in range(max_iter + 1):
        left = {i: f for i, f in enumerate(fits) if f.open}
        if not left:
            break
        last = settled & set(left) if step < max_iter else set(left)

        def work(xs, w, left=left, last=last):
            for i, f, x, d in _distances(xs, left):
                own = None if f.run.weight is None else w[:, f.run.weight]
                if i in last:
                    far = ((x - f.centres[d.argmin(axis=0)]) ** 2).sum(axis=1)
                    yield i, np.array([far.sum() if own is None else own @ far])
                    continue
                share = _shares(d)
                if own is not None:
                    share *= own
                yield i, np.concatenate([(share @ x).ravel(), share.sum(axis=1)])

        found = _sums(df, tables, weights, width, work)
        for i, f in left.items():
            k, d = f.centres.shape
            v = found[i]
            if i in last:
                f.cost, f.open = float(v[0]), False
                continue
            size = v[k * d:, None]
            moved = np.where(size > 0, v[:k * d].reshape(k, d) / np.where(size > 0, size, 1), f.centres)
            if ((moved - f.centres) ** 2).sum(axis=1).max() <= tol ** 2:
                settled.add(i)
            f.centres = moved


def best_of(fits: Iterable[Fit]) -> dict[Hashable, Fit]:
    """The cheapest fit of each key."""
    best: dict[Hashable, Fit] = {}
    for f in fits:
        if f.run.key not in best or f.cost < best[f.run.key].cost:
            best[f.run.key] = f
    return best


def silhouettes(df: DataFrame, fits: dict[Hashable, Fit]) -> dict[Hashable, float | None]:
    """Squared-Euclidean silhouette of every fit, in two passes over the rows: sums by cluster, then each row's own value.
    Rows alone in their cluster count 0; a single cluster has none."""
    tables = sorted({f.run.table for f in fits.values()})
    width = sum(f.run.k for f in fits.values())
    with _spread(df.select(*tables), df.count(), width) as rows:
        return _silhouettes(rows, fits, tables, width)


def _silhouettes(rows: DataFrame, fits: dict[Hashable, Fit], tables: Sequence[str], width: int) -> dict[Hashable, float | None]:
    keys = list(fits)
    own = {i: fits[k] for i, k in enumerate(keys)}

    def sums(xs, _):
        for i, f, x, d in _distances(xs, own):
            share = _shares(d)
            yield i, np.concatenate([(share @ x).ravel(), share @ (x * x).sum(axis=1), share.sum(axis=1)])

    moments = {}
    for i, v in _sums(rows, tables, None, width, sums).items():
        k, d = own[i].centres.shape
        n = v[k * d + k:]
        full = np.maximum(n, 1)
        moments[i] = v[:k * d].reshape(k, d) / full[:, None], v[k * d:k * d + k] / full, n

    def values(xs, _):
        for i, f, x, d in _distances(xs, own):
            near = d.argmin(axis=0)
            mean, square, n = moments[i]
            at = np.arange(len(x))
            apart = (x * x).sum(axis=1)[:, None] - 2 * (x @ mean.T) + square  # mean squared distance to each cluster
            size = n[near]
            a = apart[at, near] * size / np.maximum(size - 1, 1)
            apart[:, n == 0] = np.inf
            apart[at, near] = np.inf
            b = apart.min(axis=1)
            most = np.maximum(a, b)
            s = np.where((size > 1) & (most > 0) & np.isfinite(b), (b - a) / np.where(most > 0, most, 1), 0.0)
            yield i, np.array([s.sum(), len(s)])

    found = _sums(rows, tables, None, width, values)
    return {k: float(found[i][0] / found[i][1]) if (moments[i][2] > 0).sum() > 1 else None for i, k in enumerate(keys)}


def adjusted_rands(df: DataFrame, base: Fit, fits: dict[Hashable, Fit], weights: str | None = None) -> dict[Hashable, float]:
    """Adjusted Rand index of every fit against ``base`` on the rows that its weights draw, in one pass."""
    keys = list(fits)
    own = {i: fits[k] for i, k in enumerate(keys)}
    tables = sorted({base.run.table, *(f.run.table for f in own.values())})

    def cells(xs, w):
        first = next(d for _, _, _, d in _distances({base.run.table: xs[base.run.table]}, {0: base})).argmin(axis=0)
        for i, f, _, d in _distances(xs, own):
            drawn = np.ones(len(first), bool) if f.run.weight is None else w[:, f.run.weight] > 0
            pair = first * f.run.k + d.argmin(axis=0)
            yield i, np.bincount(pair[drawn], minlength=base.run.k * f.run.k)

    found = _sums(df, tables, weights, sum(f.run.k for f in own.values()) + base.run.k, cells)
    out = {}
    for i, k in enumerate(keys):
        table = found[i].reshape(base.run.k, -1)
        both, a, b, n = (float((v * (v - 1) / 2).sum()) for v in (table, table.sum(axis=1), table.sum(axis=0), table.sum()))
        expected = a * b / n if n else 0.0
        most = (a + b) / 2
        out[k] = 1.0 if most == expected else (both - expected) / (most - expected)
    return out
