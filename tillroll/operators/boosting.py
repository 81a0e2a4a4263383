"""Gradient-boosted trees on several tables at once.

The trees are those of MLlib's ``GBTClassifier``: log loss, residuals of all earlier rounds as targets, splits by
variance among at most ``MAX_BINS`` bins a feature, the first tree with weight 1 and all others with the step size.
One pass over the rows grows one level of the trees of all tables: a task keeps its rows as blocks of byte bins
with their margins, and gives back sums by (table, node), which are added up and turned into the best split where
they meet.  A round so has as many passes as its trees have levels, whatever the number of tables; the driver keeps the trees.

Rows, bins and margins are cached between the passes, and checkpointed every few rounds to cut the lineage.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterable, Iterator, Sequence
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir, in_parallel

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_BINS = 128          # a bin is kept as one byte
CHECKPOINT_ROUNDS = 10
PURE = np.finfo(float).eps
#: Rows whose margins are found at once when a model is applied.
ROWS = 1 << 16
#: Rows of one task of a pass: from the first number on there are as many tasks as cores, from the second on more.
LEAST_ROWS, MOST_ROWS = 250_000, 2_000_000
#: Bytes of sums that one task adds up.
SENT = 4 << 20


#: What the tasks need of a tree: feature, cut, left child and value of each node, and the open nodes.
Nodes = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]
#: Rows of one table: its number, bins by (feature, row), targets -1 and 1, and the sum of the trees so far.
Block = tuple[int, np.ndarray, np.ndarray, np.ndarray]


def reached(nodes: Nodes, x: np.ndarray) -> np.ndarray:
    """The lowest node of each row (rows are the columns of ``x``)."""
    feature, cut, left = nodes[:3]
    node = np.zeros(x.shape[1], int)
    rows = np.arange(x.shape[1]) if left[0] >= 0 else node[:0]
    while len(rows):
        at = node if len(rows) == len(node) else node[rows]
        at = left[at] + ~(x[feature[at], rows] <= cut[at])  # NaN goes right, as into the last bin
        if len(rows) == len(node):
            node = at
        else:
            node[rows] = at
        down = left[at] >= 0
        rows = rows if down.all() else rows[down]
    return node


class Tree:
    """Nodes in arrays, the root first; the right child lies beside the left one, -1 for leaves.  ``cut`` is the last bin
    (or, once ``scaled``, the largest value) that goes left."""

    def __init__(self):
        self.feature, self.cut = np.zeros(1, int), np.zeros(1)
        self.left, self.value = np.full(1, -1), np.zeros(1)
        self.open = np.zeros(1, int)          # nodes of the lowest level that may be split
        self.stats: list[tuple | None] = [None]  # count, sum and sum of squares, impurity of each open node

    @property
    def nodes(self) -> Nodes:
        return self.feature, self.cut, self.left, self.value, self.open

    def grow(self, splits: dict[int, tuple], last: bool) -> None:
        """Split the open nodes; splits: place among them -> (feature, bin, count/sum/squares left and right) or the
        node's own sums alone.  Children of the last level, and those with one target value, stay leaves."""
        feature, cut, left, value = (list(a) for a in (self.feature, self.cut, self.left, self.value))
        nodes, stats = [], []
        for i, node in enumerate(self.open):
            own, best = splits[i]
            if self.stats[i] is None:
                value[node] = own[1] / own[0]
            if best is None:
                continue
            feature[node], cut[node], left[node] = best[0], best[1], len(left)
            for side in best[2:]:
                if not last and abs(impurity := float(variance(*side))) >= PURE:
                    nodes.append(len(left))
                    stats.append((*side, impurity))
                feature.append(0)
                cut.append(0.0)
                left.append(-1)
                value.append(side[1] / side[0])
        self.feature, self.cut, self.left, self.value = np.array(feature), np.array(cut, float), np.array(left), np.array(value)
        self.open, self.stats = np.array(nodes, int), stats

    def scaled(self, cuts: Sequence[np.ndarray]) -> "Tree":
        """The tree with values in place of bins."""
        out = Tree()
        out.feature, out.left, out.value = self.feature, self.left, self.value
        out.cut = np.array([cuts[f][int(c)] if down >= 0 else 0.0 for f, c, down in zip(self.feature, self.cut, self.left)])
        return out


def variance(n, s, q):
    return (q - s * s / n) / n


def cuts_of(x: np.ndarray, bins: int) -> np.ndarray:
    """Thresholds that part the values into at most ``bins`` bins of about equal counts, midway between neighbours."""
    values, counts = np.unique(x, return_counts=True)
    middle = (values[:-1] + values[1:]) / 2
    if len(middle) < bins:
        return middle
    below, step = np.cumsum(counts).astype(float), len(x) / bins
    out, goal = [], step
    for i in range(1, len(values)):
        if abs(below[i - 1] - goal) < abs(below[i] - goal):
            out.append(middle[i - 1])
            goal += step
    return np.array(out)


def table_cuts(df: DataFrame, n: int, bins: int, seed: int) -> list[np.ndarray]:
    """The thresholds of each feature; like MLlib's from about bins^2 rows where there are more (10,000 at least)."""
    wanted = max(bins * bins, 10_000)
    drawn = df if n <= wanted else df.sample(wanted / n, seed)
    x = drawn.select(vector_to_array("features").alias("x")).toPandas()["x"]
    x = np.stack(x.to_numpy()) + 0.0  # no negative zeros
    return [cuts_of(x[:, f], min(bins, n)) for f in range(x.shape[1])]


def blocks(df: DataFrame, table: int, cuts: list[np.ndarray]) -> RDD:
    """One block a partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, signs = [], []
        for b in batches:
            if b.num_rows:
                x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                found.append(np.stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)]).astype(np.uint8))
                signs.append(np.where(b.column("label").to_numpy(zero_copy_only=False) == 1, 1, -1).astype(np.int8))
        if found:
            yield pa.RecordBatch.from_pydict({"bins": [np.concatenate(found, axis=1).tobytes()],
                                              "sign": [np.concatenate(signs).tobytes()]})

    def block(row) -> Block:
        sign = np.frombuffer(row["sign"], np.int8)
        return (table, np.frombuffer(row["bins"], np.uint8).reshape(len(cuts), -1), sign, np.zeros(len(sign)))
    return df.select(vector_to_array("features").alias("x"), F.col("label").cast("int").alias("label")) \
        .mapInArrow(run, "bins binary, sign binary").rdd.map(block)


def level_sums(block: Block, trees: list[Nodes], first: bool, bins: int, most: int) -> Iterator[tuple[int, np.ndarray]]:
    """(table and place of an open node, count, sum and sum of squares of the targets by (feature, bin))."""
    table, x, sign, margin = block
    *_, left, _, open_ = nodes = trees[table]
    if not len(open_):
        return
    place = np.full(len(left), -1)
    place[open_] = np.arange(len(open_))
    at = place[reached(nodes, x)]
    if (at < 0).any():
        rows = np.flatnonzero(at >= 0)
        at, x, sign, margin = at[rows], x[:, rows], sign[rows], margin[rows]
    target = sign.astype(float) if first else 4.0 * sign / (1.0 + np.exp(2.0 * sign * margin))
    square, base, size = target * target, at * bins, len(open_) * bins
    out = np.empty((len(open_), len(x), 3, bins))
    for f, own in enumerate(x):
        i = base + own
        for j, w in enumerate((None, target, square)):
            out[:, f, j] = np.bincount(i, w, size).reshape(-1, bins)
    for i, sums in enumerate(out):
        yield table * most + i, sums


def best_split(sums: np.ndarray, stats: tuple | None, splits: np.ndarray, least: int) -> tuple[tuple, tuple | None]:
    """(count, sum and sum of squares of the node, its best split) from its sums by feature and bin; the split with
    the largest fall of variance, the first of equals, None without one that leaves ``least`` rows on either side."""
    left = np.cumsum(sums, axis=2)
    total = np.take_along_axis(left, splits[:, None, None], axis=2)
    right = total - left
    own = stats[:3] if stats else tuple(total[0, :, 0])
    used = np.flatnonzero(splits)
    if not len(used):
        return own, None
    if stats is None:
        own = tuple(left[used[0], :, 0] + right[used[0], :, 0])
    (ln, ls, lq), (rn, rs, rq) = np.moveaxis(left, 1, 0), np.moveaxis(right, 1, 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        n = ln + rn
        impurity = stats[3] if stats else variance(*own)
        gain = impurity - ln / n * variance(ln, ls, lq) - rn / n * variance(rn, rs, rq)
    right_bins = np.arange(sums.shape[2])[None, :] < splits[:, None]
    gain = np.where(right_bins & (ln >= least) & (rn >= least) & (gain > 0), gain, -np.inf)
    f, b = np.unravel_index(np.argmax(gain), gain.shape)
    if gain[f, b] == -np.inf:
        return own, None
    return own, (int(f), int(b), tuple(left[f, :, b].tolist()), tuple(right[f, :, b].tolist()))


def add_tree(block: Block, trees: list[Nodes], weight: float) -> Block:
    table, x, sign, margin = block
    return table, x, sign, margin + trees[table][3][reached(trees[table], x)] * weight


def margins(x: np.ndarray, trees: list[Nodes], weights: list[float]) -> np.ndarray:
    """The weighted sum of the trees for each row of ``x``."""
    out = np.zeros(len(x))
    for at in range(0, len(x), ROWS):
        own = np.ascontiguousarray(x[at:at + ROWS].T)
        for nodes, w in zip(trees, weights):
            out[at:at + ROWS] += nodes[3][reached(nodes, own)] * w
    return out


class Boosted(Transformer):
    """A boosted model: the sign of the weighted sum of its trees, with log-loss probabilities."""

    def __init__(self, trees: Sequence[Tree], weights: Sequence[float]):
        super().__init__()
        self.trees, self.weights = list(trees), list(weights)

    def _transform(self, df: DataFrame) -> DataFrame:
        trees, weights = [t.nodes for t in self.trees], self.weights

        @F.pandas_udf("double")
        def margin(x: pd.Series) -> pd.Series:
            return pd.Series(margins(np.stack(x.to_numpy()), trees, weights) if len(x) else np.zeros(0))
        p = 1 - 1 / (1 + F.exp(2 * F.col("_margin")))  # MLlib's order, with its ties
        return df.withColumn("_margin", margin(vector_to_array("features"))).select(
            *df.columns, array_to_vector(F.array(-F.col("_margin"), "_margin")).alias("rawPrediction"),
            array_to_vector(F.array(1 - p, p)).alias("probability"),
            (F.col("_margin") > 0).cast("double").alias("prediction"))


def fit(frames: Sequence[DataFrame], sizes: Sequence[int], maxIter: int = 100, stepSize: float = 0.1, maxDepth: int = 5,
        minInstancesPerNode: int = 1, seed: int = 42, bins: int = MAX_BINS) -> list[Boosted]:
    """One model for each table (features, label) with as many rows as ``sizes`` says; cache the tables before."""
    spark = frames[0].sparkSession
    sc = spark.sparkContext
    checkpoint_dir(spark)
    cuts = in_parallel(spark, lambda i: table_cuts(frames[i], sizes[i], bins, seed), range(len(frames)))
    splits = [np.array([len(c) for c in own]) for own in cuts]
    most = 1 << max(0, maxDepth - 1)
    # a pass is short: one task a core, unless it held more than MOST_ROWS rows
    tasks = max(min(sc.defaultParallelism, math.ceil(sum(sizes) / LEAST_ROWS)), math.ceil(sum(sizes) / MOST_ROWS))
    state = sc.union([blocks(df, i, c) for i, (df, c) in enumerate(zip(frames, cuts))]).coalesce(tasks) \
        .persist(StorageLevel.MEMORY_AND_DISK)
    before, models, weights = None, [[] for _ in frames], []
    for r in range(maxIter):
        trees = [Tree() for _ in frames]
        for depth in range(maxDepth):
            stats = {i * most + j: s for i, t in enumerate(trees) for j, s in enumerate(t.stats)}
            if not stats:
                break

            def best(found: Iterable, stats=stats) -> Iterator:
                for key, sums in found:
                    yield key, best_split(sums, stats[key], splits[key // most], minInstancesPerNode)
            sent = math.ceil(tasks / len(frames)) * len(stats) * len(cuts[0]) * 24 * bins
            parts = max(1, min(sc.defaultParallelism, len(stats), sent // SENT))
            sums = state.flatMap(partial(level_sums, trees=[t.nodes for t in trees], first=r == 0, bins=bins, most=most)) \
                .reduceByKey(np.add, parts, {k: i for i, k in enumerate(sorted(stats))}.get)
            found = dict(sums.mapPartitions(best).collect())  # a row for each open node
            if before is not None:
                before.unpersist()
                before = None
            for i, t in enumerate(trees):
                t.grow({j: found[i * most + j] for j in range(len(t.open))}, depth + 1 == maxDepth)
        weights.append(stepSize if r else 1.0)
        for own, t, c in zip(models, trees, cuts):
            own.append(t.scaled(c))
        if r + 1 < maxIter:
            before, state = state, state.map(partial(add_tree, trees=[t.nodes for t in trees], weight=weights[-1])).persist(StorageLevel.MEMORY_AND_DISK)
            if (r + 1) % CHECKPOINT_ROUNDS == 0:
                state.checkpoint()
    state.unpersist()
    return [Boosted(own, weights) for own in models]

