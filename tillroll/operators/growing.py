"""Trees and forests on many rows, grown whole inside the tasks.

The trees are those of MLlib's classifiers: gini or entropy, splits among at most ``MAX_BINS`` bins a feature, features
drawn anew for each node, Poisson(1) bags, least leaves counted with their multiplicity, leaves of one prediction merged.
MLlib sends dense sums of every open node in each round, which for deep trees is far more than the rows.  Here the rows
are bytes (one a feature), every task gets all of a table and grows its own trees: the tables move once, large nodes
are summed by bin and small ones sorted.  ``MOST_CELLS`` bounds what a task holds; larger tables are left to MLlib.

A search needs only counts of predictions, so its trees end with their task (``counts``).  A fitted model keeps its
trees as a table in the shared folder; neither ever brings large trees to the driver.
"""

from __future__ import annotations

import math
import pickle
import sys
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir, in_parallel, materialize
from .boosting import table_cuts

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_BINS = 128
#: Rows x features of the largest table that a task holds (a byte each, and about as much again for the rows of a tree).
MOST_CELLS = 100_000_000
#: Rows of a node that are summed by bin; fewer are sorted.
LARGE = 512
#: Rows x features that are sorted at once.
SORTED = 1 << 18
#: Rows that go down a tree at once.
ROWS = 1 << 15
#: Nodes of one row of a fitted forest's table, and of the largest forest that is sent to the rows.
ROW_NODES, SENT_NODES = 1_000_000, 2_000_000
#: Training rows x trees of one task, and tasks of one fit of a search at most.
TASK_CELLS, TASKS = 2_000_000, 16
POSITIVE = float(1 << 27)  # counts of rows and of positive rows are summed as one number


@dataclass(frozen=True)
class Spec:
    """One fit: how many trees, how they are grown, and the depths and numbers of trees whose counts are wanted."""
    trees: int
    depth: int
    least: int
    impurity: str
    tried: int
    bagged: bool
    seed: int
    depths: tuple[int, ...] = ()
    sizes: tuple[int, ...] = ()


@dataclass
class Tree:
    """Nodes level by level, the root first; the right child lies beside the left one, -1 for leaves.  ``cut`` is the
    last bin that goes left, ``positive`` and ``rows`` are counts, ``levels`` the first node of each level and the end."""
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    rows: np.ndarray
    positive: np.ndarray
    gain: np.ndarray
    levels: list[int]

    @property
    def share(self) -> np.ndarray:
        return self.positive / np.maximum(self.rows, 1)

    def leaves(self, depth: int) -> np.ndarray:
        """Which nodes are leaves, or lie below one, in the tree cut at ``depth``; two leaves of one prediction are merged."""
        leaf = self.left < 0
        last = min(depth, len(self.levels) - 2)
        leaf[self.levels[last]:] = True
        predicted = 2 * self.positive > self.rows
        for d in range(last - 1, -1, -1):
            at = self.levels[d] + np.flatnonzero(~leaf[self.levels[d]:self.levels[d + 1]])
            a = self.left[at]
            leaf[at] = leaf[a] & leaf[a + 1] & (predicted[a] == predicted[a + 1])
        return leaf

    def importance(self, leaf: np.ndarray, features: int) -> np.ndarray:
        """Gain x rows of the inner nodes by feature, as shares."""
        inner = ~leaf
        out = np.bincount(self.feature[inner], self.gain[inner] * self.rows[inner], features)
        return out / (out.sum() or 1.0)

    def pruned(self, leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """feature, cut, left child and share of the nodes that are left when ``leaf`` are leaves."""
        keep = np.zeros(len(leaf), bool)
        keep[0] = True
        inner = np.flatnonzero(~leaf)
        keep[self.left[inner]] = keep[self.left[inner] + 1] = True
        place = np.cumsum(keep) - 1
        left = np.where(leaf, -1, place[self.left])
        return self.feature[keep].astype(np.int16), self.cut[keep], left[keep].astype(np.int32), self.share[keep]


def impurity_of(kind: str, rows, positive):
    """Of nodes with rows, in MLlib's order of operations, as the rounding decides between equal splits."""
    a, b = (rows - positive) / rows, positive / rows
    if kind == "gini":
        return 1.0 - a * a - b * b
    log = lambda x: np.log(x, out=np.zeros(len(x)), where=x > 0) / np.log(2.0)
    return 0.0 - a * log(a) - b * log(b)


#: Of each node: gain, feature, bin, rows and positive rows left of its best split.
Splits = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def no_splits(k: int) -> Splits:
    return np.zeros(k), np.zeros(k, int), np.zeros(k, int), np.zeros(k), np.zeros(k)


def put(best: Splits, nodes, spec: Spec, node, tried, bins, left_rows, left_positive, whole, rows, positive) -> None:
    """Enter the best of some splits (in the order of their nodes) where it is better than before; the first of equals."""
    t = rows.take(node)
    right_rows = t - left_rows
    if spec.least > 1:
        ok = np.flatnonzero((left_rows >= spec.least) & (right_rows >= spec.least))
        node, tried, bins, left_rows, left_positive, right_rows, t = (a[ok] for a in (node, tried, bins, left_rows, left_positive, right_rows, t))
    if not len(node):
        return
    right_positive = positive.take(node) - left_positive
    gain = whole.take(node) - left_rows / t * impurity_of(spec.impurity, left_rows, left_positive)
    gain -= right_rows / t * impurity_of(spec.impurity, right_rows, right_positive)
    starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
    most = np.zeros(len(rows))
    most[node[starts]] = np.maximum.reduceat(gain, starts)
    most[most <= best[0][nodes]] = np.inf
    top = np.flatnonzero(gain == most.take(node))
    own, first = np.unique(node[top], return_index=True)
    i, at = top[first], nodes[own]
    for to, of in zip(best, (gain, tried, bins, left_rows, left_positive)):
        to[at] = of[i]


def large_splits(best: Splits, nodes, spec: Spec, flat, m, rows, size, tried, val, *own) -> None:
    """The best splits of ``nodes``, whose rows are summed by bin."""
    k = len(size)
    node = np.repeat(np.arange(k), size)
    val, base = val.take(rows), node * MAX_BINS
    for j in range(tried.shape[1]):
        sums = np.bincount(flat.take((tried[:, j] * m).take(node) + rows) + base, val, k * MAX_BINS).reshape(k, MAX_BINS)
        positive = np.floor(sums / POSITIVE)
        left = np.cumsum(sums - positive * POSITIVE, axis=1)
        at = np.flatnonzero((sums > 0) & (left < left[:, -1:]))  # something lies in the bin, and right of it
        of = at >> 7
        put(best, nodes, spec, of, tried[of, j], at & 127, left.ravel()[at], np.cumsum(positive, axis=1).ravel()[at], *own)


def small_splits(best: Splits, nodes, spec: Spec, flat, m, rows, size, tried, code, bits, *own) -> None:
    """As ``large_splits``, by sorting the rows of each node and feature by bin."""
    k, q = tried.shape
    kind = np.int32 if bits <= 6 and k * q <= 1 << 18 else np.int64
    node = np.repeat(np.arange(k), size)
    code, key = code.take(rows), np.empty((q, len(rows)), kind)
    for j in range(q):
        key[j] = (node * q + j) << (7 + bits) | flat.take((tried[:, j] * m).take(node) + rows).astype(np.int64) << bits | code
    key = key.ravel()
    key.sort()
    weight = (key & ((1 << bits) - 1)) >> 1
    left, positive = np.cumsum(weight), np.cumsum(weight * (key & 1))
    key >>= bits
    other = key[1:] ^ key[:-1]
    at = np.flatnonzero((other > 0) & (other < MAX_BINS))  # the bin is another, node and feature are not
    ends = np.cumsum(np.repeat(size, q))[:-1] - 1
    key = key.take(at)
    group = key >> 7
    left = left.take(at) - np.r_[0, left[ends]].take(group)
    positive = positive.take(at) - np.r_[0, positive[ends]].take(group)
    node = group // q
    put(best, nodes, spec, node, tried[node, group - node * q], key & 127, left.astype(float), positive.astype(float), *own)


def grow(x: np.ndarray, y: np.ndarray, spec: Spec, rng: np.random.Generator) -> Tree:
    """One tree on the rows (columns of ``x``, bins) with labels ``y``."""
    weight = rng.poisson(1.0, len(y)) if spec.bagged else np.ones(len(y), int)
    if spec.bagged:
        bag = np.flatnonzero(weight)
        x, y, weight = np.ascontiguousarray(x[:, bag]), y[bag], weight[bag]
    features, m = x.shape
    flat, code = x.ravel(), weight.astype(np.int32) << 1 | y
    bits = int(weight.max(initial=1)).bit_length() + 1
    val = weight * (1.0 + POSITIVE * y)
    rows, size = np.arange(m), np.array([m])
    total, positive = np.array([float(weight.sum())]), np.array([float((weight * y).sum())])
    levels, out, count = [0], [], 1

    def may_split(total, positive, depth):
        return (total >= 2 * spec.least) & (positive > 0) & (positive < total) & (depth < spec.depth)
    open_ = np.flatnonzero(may_split(total, positive, 0)) if m else np.zeros(0, int)
    if not len(open_):
        rows, size = rows[:0], size[:0]
    while True:
        here = len(total)
        feature, cut, left, gain = np.zeros(here, np.int64), np.zeros(here, np.uint8), np.full(here, -1), np.zeros(here)
        out.append((feature, cut, left, total, positive, gain))
        levels.append(count)
        if not len(open_):
            break
        t, p = total[open_], positive[open_]
        whole = impurity_of(spec.impurity, t, p)
        k = len(open_)
        tried = np.tile(np.arange(features), (k, 1)) if spec.tried >= features else \
            np.sort(np.argpartition(rng.random((k, features)), spec.tried - 1, axis=1)[:, :spec.tried], axis=1)
        found = no_splits(k)
        big = size >= LARGE
        large, small = np.flatnonzero(big), np.flatnonzero(~big)
        if len(large):
            own = rows if len(large) == k else rows[np.repeat(big, size)]
            large_splits(found, large, spec, flat, m, own, size[large], tried[large], val, whole[large], t[large], p[large])
        if len(small):
            own = rows if len(small) == k else rows[np.repeat(~big, size)]
            until, a = np.cumsum(size[small]), 0
            while a < len(small):  # some nodes at a time
                begin = until[a] - size[small[a]]
                b = max(a + 1, int(np.searchsorted(until, begin + SORTED // tried.shape[1], "right")))
                at = small[a:b]
                small_splits(found, at, spec, flat, m, own[begin:until[b - 1]], size[at], tried[at], code, bits, whole[at], t[at], p[at])
                a = b
        split = found[0] > 0
        at = open_[split]
        feature[at], cut[at], gain[at] = found[1][split], found[2][split], found[0][split]
        left[at] = count + 2 * np.arange(len(at))
        count += 2 * len(at)
        if not len(at):
            break
        side = np.stack([found[3][split], found[4][split]])
        total, positive = (np.stack([a, b - a], axis=1).ravel() for a, b in zip(side, (t[split], p[split])))
        goes = may_split(total, positive, len(levels) - 1)
        open_ = np.flatnonzero(goes)
        node = np.repeat(np.arange(k), size)
        right = flat.take((found[1] * m).take(node) + rows) > found[2].take(node)
        child = 2 * (np.cumsum(split) - 1).take(node) + right
        keep = goes.take(child, mode="wrap") & split.take(node)
        place = np.cumsum(goes) - 1
        size = np.bincount(place[child[keep]], minlength=len(open_))
        begin = np.cumsum(size) - size
        moved = np.empty(int(size.sum()), int)
        for side in (keep & ~right, keep & right):  # the rows of one side already stand in the order of their nodes
            at = np.flatnonzero(side)
            own = place.take(child.take(at))
            first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(at) else at
            moved[np.repeat(begin[own[first]] - first, np.diff(np.r_[first, len(at)])) + np.arange(len(at))] = rows[at]
        rows = moved
    return Tree(*(np.concatenate(a) for a in zip(*out)), levels)


def chunks(x: np.ndarray) -> list[np.ndarray]:
    return [np.ascontiguousarray(x[:, a:a + ROWS]) for a in range(0, x.shape[1], ROWS)]


def down(feature, cut, left, x: np.ndarray, leaves: Sequence[np.ndarray]) -> Iterator[np.ndarray]:
    """The leaf that each row (column of ``x``) reaches, for each of the rising sets of ``leaves``: a leaf of a deeper
    cut lies at or below that of an earlier one."""
    n, flat = x.shape[1], x.ravel()
    node, at_row = np.zeros(n, int), feature.astype(np.int64) * n
    for leaf in leaves:
        rows = np.flatnonzero(~leaf.take(node))
        at = node.take(rows)
        while len(rows):
            at = left.take(at) + (flat.take(at_row.take(at) + rows) > cut.take(at))
            ends = leaf.take(at)
            if ends.any():
                node[rows[ends]] = at[ends]
                on = np.flatnonzero(~ends)
                rows, at = rows.take(on), at.take(on)
        yield node


def packed(df: DataFrame, cuts: list[np.ndarray], tag: tuple) -> RDD:
    """(tag, number, bins by (feature, row), labels) of each partition of ``df`` (features, label)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, labels = [], []
        for b in batches:
            if b.num_rows:
                x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1) + 0.0
                found.append(binned(x, cuts))
                labels.append(b.column("label").to_numpy(zero_copy_only=False) == 1)
        if found:
            yield pa.RecordBatch.from_pydict({"x": [np.concatenate(found, axis=1).tobytes()], "y": [np.concatenate(labels).tobytes()]})
    rows = df.select(vector_to_array("features").alias("x"), F.col("label").cast("int").alias("label")).mapInArrow(run, "x binary, y binary")
    return rows.rdd.mapPartitionsWithIndex(lambda i, it: [(tag, i, bytes(r["x"]), bytes(r["y"])) for r in it])


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)]).astype(np.uint8)


def table(found: Iterable[tuple], features: int) -> tuple[np.ndarray, np.ndarray]:
    """The bins and labels of the blocks, in the order of their numbers."""
    found = sorted(found, key=lambda b: b[1])
    if not found:
        return np.zeros((features, 0), np.uint8), np.zeros(0, bool)
    return (np.concatenate([np.frombuffer(b[2], np.uint8).reshape(features, -1) for b in found], axis=1),
            np.concatenate([np.frombuffer(b[3], bool) for b in found]))


def rng_of(spec: Spec, tree: int) -> np.random.Generator:
    return np.random.default_rng([abs(spec.seed), tree])


def ranges(spec: Spec, parts: int) -> list[tuple[int, int]]:
    edges = [spec.trees * i // parts for i in range(parts + 1)]
    return list(zip(edges, edges[1:]))


def dealt(blocks: RDD, wanted: dict, jobs: int) -> RDD:
    """Each block sent to the jobs that want its tag, a partition for each job: (job, its blocks)."""
    def gather(it):
        own = {}
        for job, block in it:
            own.setdefault(job, []).append(block)
        return own.items()
    return blocks.flatMap(lambda b: [(j, b) for j in wanted[b[0]]]).partitionBy(jobs, int).mapPartitions(gather)


def four(positive: np.ndarray, y: np.ndarray) -> list[int]:
    """tp, fp, fn, tn."""
    return [int(v.sum()) for v in (positive & y, positive & ~y, ~positive & y, ~positive & ~y)]


def counts(tables: Sequence[tuple[DataFrame, DataFrame]], sizes: Sequence[int], fits: Sequence[tuple[int, Spec]],
           features: int, bins: int = MAX_BINS, seed: int = 42) -> list[dict[tuple[int, int], dict]]:
    """For each fit (number of its table, spec): tp, fp, fn, tn of the table's second frame by (depth, number of trees),
    grown on the first one, which has as many rows as ``sizes`` says.  Cache the frames (features, label) before."""
    spark = tables[0][0].sparkSession
    checkpoint_dir(spark)
    used = sorted({i for i, _ in fits})
    cuts = dict(zip(used, in_parallel(spark, lambda i: table_cuts(tables[i][0], sizes[i], bins, seed), used)))
    jobs = [(f, i, *r) for f, (i, s) in enumerate(fits)
            for r in ranges(s, max(1, min(TASKS, s.trees, math.ceil(s.trees * sizes[i] / TASK_CELLS))))]
    parts = {f: sum(j[0] == f for j in jobs) for f in range(len(fits))}
    wanted = {(i, kind): [j for j, job in enumerate(jobs) if job[1] == i] for i in used for kind in (0, 1)}
    blocks = spark.sparkContext.union([packed(tables[i][kind], cuts[i], (i, kind)) for i in used for kind in (0, 1)])

    def run(item):
        job, own = item
        fit, _, first, end = jobs[job]
        spec = fits[fit][1]
        x, y = table([b for b in own if not b[0][1]], features)
        vx, vy = table([b for b in own if b[0][1]], features)
        held = chunks(vx)
        sums: dict[int, np.ndarray] = {}  # by the first number of trees that holds them
        for t in range(first, end):
            tree = grow(x, y, spec, rng_of(spec, t))
            share, leaves = tree.share, [tree.leaves(d) for d in spec.depths]
            into = sums.setdefault(sum(t >= s for s in spec.sizes), np.zeros((len(spec.depths), len(vy))))
            a = 0
            for chunk in held:
                for d, node in enumerate(down(tree.feature, tree.cut, tree.left, chunk, leaves)):
                    into[d, a:a + chunk.shape[1]] += share[node]
                a += chunk.shape[1]
        if parts[fit] == 1:
            yield fit, (first, None, added(spec, [(first, sums)], vy))
        else:
            yield fit, (first, vy.tobytes() if not first else b"", {k: v.tobytes() for k, v in sums.items()})

    def join(item):
        fit, own = item
        own = sorted(own, key=lambda r: r[0])
        if own[0][1] is None:
            return fit, own[0][2]
        spec, y = fits[fit][1], np.frombuffer(own[0][1], bool)
        return fit, added(spec, [(at, {k: np.frombuffer(v).reshape(len(spec.depths), -1) for k, v in sums.items()}) for at, _, sums in own], y)

    def gather(it):
        own = {}
        for fit, r in it:
            own.setdefault(fit, []).append(r)
        return map(join, own.items())
    grown = dealt(blocks, wanted, len(jobs)).flatMap(run)
    found = dict(grown.partitionBy(len(fits), int).mapPartitions(gather).collect())  # four counts for each depth and size
    return [found[f] for f in range(len(fits))]


def added(spec: Spec, sums: list[tuple[int, dict[int, np.ndarray]]], y: np.ndarray) -> dict[tuple[int, int], dict]:
    """The counts of each depth and number of trees from the sums of shares of the trees up to it."""
    out, so_far = {}, np.zeros((len(spec.depths), len(y)))
    for place, size in enumerate(spec.sizes):
        for _, own in sums:
            if place in own:
                so_far = so_far + own[place]
        for d, depth in enumerate(spec.depths):
            out[depth, size] = dict(zip(("tp", "fp", "fn", "tn"), four(so_far[d] > size - so_far[d], y)))
    return out


class Grown(Transformer):
    """A fitted tree or forest.  ``trees`` is a table in the shared folder: a row holds some trees."""

    def __init__(self, trees: DataFrame, size: int, nodes: int, cuts: list[np.ndarray], importances: Sequence[float]):
        super().__init__()
        self.trees, self.size, self.nodes, self.cuts = trees, size, nodes, cuts
        self.featureImportances = list(importances)

    @property
    def getNumTrees(self) -> int:
        return self.size

    def _transform(self, df: DataFrame) -> DataFrame:
        size, cuts = self.size, self.cuts
        if self.nodes <= SENT_NODES:  # the trees go to the rows
            held = [pickle.loads(r["trees"]) for r in self.trees.orderBy("first").collect()]

            @F.pandas_udf("double")
            def votes(x: pd.Series) -> pd.Series:
                return pd.Series(sum((shares(own, binned(np.stack(x.to_numpy()) + 0.0, cuts)) for own in held), np.zeros(len(x)))
                                 if len(x) else np.zeros(0))
            out = df.withColumn("_votes", votes(vector_to_array("features")))
        else:
            out = self.met(df)
        p = F.col("_votes") / size
        return out.select(*df.columns, array_to_vector(F.array(size - F.col("_votes"), "_votes")).alias("rawPrediction"),
                          array_to_vector(F.array(1 - p, p)).alias("probability"),
                          (F.col("_votes") > size - F.col("_votes")).cast("double").alias("prediction"))

    def met(self, df: DataFrame) -> DataFrame:
        """``df`` with the sum of the trees' shares (``_votes``), where the trees are too many to be sent: blocks of
        rows and of trees meet in pairs, and the sums of a block are added in the order of the trees."""
        cuts = self.cuts
        rows = materialize(df.withColumn("_row", F.monotonically_increasing_id()))

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1) + 0.0
                    yield pa.RecordBatch.from_pydict({"rows": [b.column("_row").to_numpy().tobytes()], "x": [binned(x, cuts).tobytes()]})
        blocks = rows.select("_row", vector_to_array("features").alias("x")).mapInArrow(pack, "rows binary, x binary").rdd \
            .map(lambda r: (bytes(r["rows"]), bytes(r["x"]))).glom().filter(len) \
            .map(lambda own: (b"".join(r for r, _ in own), np.concatenate([np.frombuffer(x, np.uint8).reshape(len(cuts), -1) for _, x in own], axis=1))) \
            .persist(StorageLevel.MEMORY_AND_DISK)

        def meet(pair):
            trees, (ids, x) = pair
            return ids[:8], (trees["first"], ids, np.concatenate([shares(pickle.loads(trees["trees"]), c) for c in chunks(x)]))

        def total(own):
            own = sorted(own, key=lambda r: r[0])
            return zip(np.frombuffer(own[0][1], np.int64).tolist(), sum((v for *_, v in own), np.zeros(len(own[0][1]) // 8)).tolist())
        sums = self.trees.rdd.cartesian(blocks).map(meet).groupByKey(blocks.getNumPartitions()).flatMap(lambda kv: total(kv[1]))
        found = materialize(df.sparkSession.createDataFrame(sums, "_row long, _votes double"))
        blocks.unpersist()
        return rows.join(found, "_row")


def shares(trees: Sequence[tuple], x: np.ndarray) -> np.ndarray:
    """The sum over the trees of the share of the leaf that each row reaches."""
    n, flat = x.shape[1], x.ravel()
    rows, out = np.arange(n), np.zeros(n)
    for feature, cut, left, share in trees:
        leaf = left < 0
        to = np.where(leaf, np.arange(len(left)), left)  # a row stays in its leaf
        most, at_row, at = np.where(leaf, 255, cut).astype(np.uint8), feature.astype(np.int64) * n, np.zeros(n, int)
        while not leaf.take(at).all():
            at = to.take(at) + (flat.take(at_row.take(at) + rows) > most.take(at))
        out += share.take(at)
    return out


def fit(x: DataFrame, n: int, spec: Spec, features: int, bins: int = MAX_BINS) -> Grown:
    """The tree or forest on the ``n`` rows of ``x`` (features, label); cache it before."""
    spark = x.sparkSession
    checkpoint_dir(spark)
    cuts = table_cuts(x, n, bins, spec.seed)
    tasks = min(spec.trees, 2 * spark.sparkContext.defaultParallelism, max(1, math.ceil(n * spec.trees / TASK_CELLS)))
    jobs = ranges(spec, tasks)

    def run(item):
        job, own = item
        rows, labels = table(own, features)
        held, nodes, importance, begin = [], 0, np.zeros(features), jobs[job][0]
        for t in range(*jobs[job]):
            tree = grow(rows, labels, spec, rng_of(spec, t))
            leaf = tree.leaves(spec.depth)
            held.append(tree.pruned(leaf))
            importance += tree.importance(leaf, features)
            nodes += len(held[-1][0])
            if nodes >= ROW_NODES or t + 1 == jobs[job][1]:
                yield begin, nodes, pickle.dumps(held, 5), importance.tolist()
                held, nodes, importance, begin = [], 0, np.zeros(features), t + 1
    grown = dealt(packed(x, cuts, ()), {(): range(len(jobs))}, len(jobs)).flatMap(run)
    trees = materialize(spark.createDataFrame(grown, "first int, nodes long, trees binary, importance array<double>"))
    found = trees.select("first", "nodes", "importance").orderBy("first").collect()  # a row for a million nodes
    total = sum((np.array(r["importance"]) for r in found), np.zeros(features))
    return Grown(trees, spec.trees, sum(r["nodes"] for r in found), cuts, (total / (total.sum() or 1.0)).tolist())
