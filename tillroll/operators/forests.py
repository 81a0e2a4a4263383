"""Nested evaluation of tree ensembles (P19): many grid points from one deep fit.

Greedy splits do not depend on the depth limit, and inner nodes keep their class counts, so a fit at the largest
depth holds the tree of every smaller one: cut at that depth, the nodes there become leaves, and inner nodes whose
two leaves agree become one, as in a fit at that depth.  The first m trees of a forest are a forest of m trees.
Only the other parameters (impurity, least leaf size, features tried) need fits of their own.

The nodes are read from the saved model as a table.  Rows are scored where they lie, under all depths and sizes
in one pass, and only the four counts of each are brought together.
"""

from __future__ import annotations

import math
import sys
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])

NESTED = ("maxDepth", "numTrees")
#: Cells of rows x trees that are followed at once.
CELLS = 1 << 20


@dataclass
class Forest:
    """All nodes of all trees; children are places in the arrays, -1 for leaves."""
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    positive: np.ndarray   # share of the positive class among the node's training rows
    predicted: np.ndarray
    depth: np.ndarray

    @classmethod
    def of(cls, nodes: pd.DataFrame) -> "Forest":
        """nodes: tree, id (0 is the root, counted within the tree), prediction, stats, left, right, feature, threshold."""
        nodes = nodes.sort_values(["tree", "id"])
        tree, at = nodes["tree"].to_numpy(), np.arange(len(nodes))
        roots = at[np.r_[True, tree[1:] != tree[:-1]]]
        base = np.repeat(roots, np.diff(np.r_[roots, len(nodes)]))
        left, right = nodes["left"].to_numpy(), nodes["right"].to_numpy()
        inner = left >= 0
        left, right = np.where(inner, base + left, -1), np.where(inner, base + right, -1)
        stats = np.stack(nodes["stats"].to_numpy()).astype(float)
        total = stats.sum(axis=1)
        depth, level, d = np.zeros(len(nodes), int), roots, 0
        while len(level):
            depth[level] = d
            level = level[left[level] >= 0]
            level, d = np.concatenate([left[level], right[level]]), d + 1
        return cls(roots, nodes["feature"].to_numpy(), nodes["threshold"].to_numpy(float), left, right,
                   np.divide(stats[:, 1], total, out=np.zeros(len(total)), where=total > 0),
                   nodes["prediction"].to_numpy(float), depth)

    def leaves(self, depth: int) -> np.ndarray:
        """Which nodes are leaves, or would lie below one, in the trees cut at ``depth``."""
        leaf = (self.left < 0) | (self.depth >= depth)
        for d in range(min(depth, int(self.depth.max(initial=0))) - 1, -1, -1):
            at = np.flatnonzero((self.depth == d) & ~leaf)
            a, b = self.left[at], self.right[at]
            leaf[at] = leaf[a] & leaf[b] & (self.predicted[a] == self.predicted[b])
        return leaf

    def reached(self, x: np.ndarray, leaf: np.ndarray) -> np.ndarray:
        """The leaf that each row reaches in each tree."""
        node = np.tile(self.roots, (len(x), 1))
        rows, trees = np.nonzero(~leaf[node])
        while len(rows):
            at = node[rows, trees]
            down = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            node[rows, trees] = down
            on = ~leaf[down]
            rows, trees = rows[on], trees[on]
        return node

    def votes(self, x: np.ndarray, leaf: np.ndarray, sizes: Sequence[int]) -> list[np.ndarray]:
        """Predicted class of each row by the first m trees, for each m: class 1 if it has more than half of the shares."""
        share = self.positive[self.reached(x, leaf)]
        return [share[:, :m].sum(axis=1) > (1 - share[:, :m]).sum(axis=1) for m in sizes]


def saved_nodes(model) -> DataFrame:
    """The nodes of a fitted tree or forest, as a table in the shared folder."""
    path = f"{checkpoint_dir(model_session(model)).rstrip('/')}/forest-{uuid.uuid4().hex}"
    model.write().save(path)
    data = model_session(model).read.parquet(f"{path}/data")
    if "treeID" in data.columns:
        data = data.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        data = data.withColumn("tree", F.lit(0))
    return data.select("tree", "id", "prediction", F.col("impurityStats").alias("stats"), F.col("leftChild").alias("left"),
                       F.col("rightChild").alias("right"), F.col("split.featureIndex").alias("feature"),
                       F.coalesce(F.try_element_at("split.leftCategoriesOrThreshold", F.lit(1)), F.lit(0.0)).alias("threshold"))


def model_session(model):
    from pyspark.sql import SparkSession
    return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


def nested_counts(model, df: DataFrame, depths: Sequence[int], sizes: Sequence[int]) -> dict[tuple[int, int], dict]:
    """tp, fp, fn, tn of the rows (features, label) for each (depth, number of trees) within ``model``.

    The model is a binary classifier on numeric features.  Like MLlib's own models it is held by the driver and sent
    to the tasks; its size is bounded by its trees and their depth, not by ``df``."""
    forest = Forest.of(saved_nodes(model).toPandas())
    cuts = [(d, forest.leaves(d)) for d in depths]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(cuts), len(sizes), 4), np.int64)
        step = max(1, CELLS // len(forest.roots))
        for pdf in frames:
            if not len(pdf):
                continue
            x, y = np.stack(pdf["x"].to_numpy()), pdf["label"].to_numpy() == 1
            for at in range(0, len(x), step):
                own = y[at:at + step]
                for i, (_, leaf) in enumerate(cuts):
                    for j, p in enumerate(forest.votes(x[at:at + step], leaf, sizes)):
                        total[i, j] += [(p & own).sum(), (p & ~own).sum(), (~p & own).sum(), (~p & ~own).sum()]
        yield pd.DataFrame([(d, m, *total[i, j]) for i, (d, _) in enumerate(cuts) for j, m in enumerate(sizes)],
                           columns=["depth", "trees", "tp", "fp", "fn", "tn"])

    counts = df.select(vector_to_array("features").alias("x"), F.col("label").cast("int").alias("label")) \
        .mapInPandas(run, "depth int, trees int, tp long, fp long, fn long, tn long")
    total = counts.groupBy("depth", "trees").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")])
    found = {(r["depth"], r["trees"]): r.asDict() for r in total.collect()}  # a row for each depth and size
    empty = dict(tp=0, fp=0, fn=0, tn=0)
    return {(d, m): found.get((d, m), empty) for d in depths for m in sizes}


def f1(counts: dict) -> float:
    """F1 of the positive class from the counts; 0 without a true positive."""
    tp, wrong = counts["tp"], counts["fp"] + counts["fn"]
    return 2.0 * tp / (2 * tp + wrong) if tp else 0.0


def tried(strategy: str, features: int) -> str:
    """The number of features that MLlib tries at a split under a named root or a share of all, as text."""
    if strategy == "sqrt":
        return str(math.ceil(math.sqrt(features)))
    if "." in strategy:
        return str(math.ceil(float(strategy) * features))
    return strategy


def nested_groups(points: Sequence[dict], features: int | None = None) -> list[tuple[dict, list[int]]]:
    """(parameters of the one fit, places of its points): points that differ in depth and size alone share a fit, and, where
    the number of ``features`` is given, so do strategies that try the same number of them (one seed, one model)."""
    groups: dict[tuple, list[int]] = {}
    for i, p in enumerate(points):
        own = {k: v for k, v in p.items() if k not in NESTED}
        if features and "featureSubsetStrategy" in own:
            own["featureSubsetStrategy"] = tried(own["featureSubsetStrategy"], features)
        groups.setdefault(tuple(sorted(own.items())), []).append(i)
    out = []
    for places in groups.values():
        own = [points[i] for i in places]
        out.append((own[0] | {k: max(p[k] for p in own) for k in NESTED if all(k in p for p in own)}, places))
    return out
