"""Supervised learning on the customer feature table.

log1p + scaling is fitted on the training rows of a fold only, once per fold;
its vectors are cached in partitions sized by their rows and every candidate of
that fold is fitted on them, several at a time.  Trees and forests on many rows are grown whole inside the tasks
(``growing``), smaller ones are MLlib's, a middling forest in parts.  Folds are exact within each label.  Everything downstream (metrics, tests, bands, scoring) is a DataFrame
aggregate over predictions.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import unit_hash
from ..functions.quantiles import quantiles
from ..session import PARALLELISM, in_parallel, materialize
from . import boosting
from . import evaluate as E
from . import forests
from . import growing

BASE_FEATURES = ["recency", "frequency", "monetary", "avg_order_value", "tenure"]
RICH_FEATURES = BASE_FEATURES + ["ipt_mean", "ipt_std", "max_invoice_value", "std_invoice_value",
                                 "avg_items_per_invoice", "distinct_products", "total_quantity", "active_months",
                                 "spend_last90", "momentum_ratio", "purchase_rate"]
MODELS = ("logistic_regression", "decision_tree", "random_forest")
NESTED_MODELS = ("decision_tree", "random_forest")
ROWS_PER_PARTITION = 100_000
#: Every partition of a tree fit sends histograms of all nodes that are split at once: where several fits
#: share the cores, fewer and larger partitions send fewer of them.
TREE_ROWS_PER_PARTITION = 500_000
#: Training rows x trees of one part of a forest, from which on it is fitted in parts.
FOREST_PART = 1_000_000
#: Training rows, or training rows x trees, from which on trees are grown whole inside the tasks.
GROWN_ROWS, GROWN_CELLS = 20_000, 2_000_000
#: Training rows over the least leaf size (a tree has at most twice as many nodes) of the trees grown at a time.
DEEP_ROWS = 1_500_000
MAX_DEPTH = 30     # MLlib's deepest tree, for an unlimited one
MAX_BINS = 128     # candidate thresholds per feature; MLlib cannot try every value

# The settings that are compared untuned (P18) and fitted as given.
DEFAULTS = {
    "logistic_regression": {"C": 1.0},
    "decision_tree": {"maxDepth": MAX_DEPTH},
    "random_forest": {"numTrees": 100, "maxDepth": MAX_DEPTH, "featureSubsetStrategy": "sqrt"},
    "gradient_boosting": {"maxIter": 100, "stepSize": 0.1, "maxDepth": 5, "minInstancesPerNode": 20},
}
FIXED = {
    "logistic_regression": {"C": 1.0},
    "decision_tree": {"maxDepth": 6},
    "random_forest": {"numTrees": 200, "maxDepth": 8, "featureSubsetStrategy": "sqrt"},
}
# The grids of P19, 5 + 70 + 64 points.
GRIDS = {
    "logistic_regression": {"C": [0.01, 0.1, 1.0, 10.0, 100.0]},
    "decision_tree": {"maxDepth": [3, 4, 5, 6, 8, 10, MAX_DEPTH], "minInstancesPerNode": [1, 5, 10, 20, 50],
                      "impurity": ["gini", "entropy"]},
    "random_forest": {"numTrees": [200, 400], "maxDepth": [5, 8, 12, MAX_DEPTH],
                      "minInstancesPerNode": [1, 5, 10, 20], "featureSubsetStrategy": ["sqrt", "0.5"]},
}


def with_folds(df: DataFrame, k: int = 5, seed: int = 42, key: str = "customer_id", label: str = "label") -> DataFrame:
    """Fold id in [0, k), exact within each label: sizes differ by at most one.

    The folds of a label are cut at the exact i/k quantiles of the hashed key, so no window spans
    a label.  ``df`` is read several times: pass a materialised table.
    """
    drawn = df.withColumn("_u", unit_hash(F.col(key), seed=f"cv{seed}"))
    names = [f"_cut{i}" for i in range(1, k)]
    cuts = quantiles(drawn, "_u", [i / k for i in range(1, k)], by=[label], names=names)  # one row a label
    fold = sum(((F.col("_u") > F.col(c)).cast("int") for c in names), F.lit(0))
    return drawn.join(F.broadcast(cuts), label).select(*df.columns, fold.alias("fold"))


def preprocessing(train: DataFrame, features: Sequence[str], one_hot: str | None = None) -> PipelineModel:
    """log1p, then centre and scale by the mean and population sd of ``train`` (a constant
    feature is only centred); optionally one-hot a categorical (unknown levels are all zero).
    The scaled columns ``<feature>_z`` stay beside the vector ``features``."""
    logs = {c: f"log1p(CAST({c} AS DOUBLE))" for c in features}
    m = train.agg(*[F.expr(f"avg({x})").alias(f"m_{c}") for c, x in logs.items()],
                  *[F.expr(f"stddev_pop({x})").alias(f"s_{c}") for c, x in logs.items()]).first()
    if any(m[f"m_{c}"] is None for c in features):
        raise ValueError("no training rows with these features")
    scaled = ", ".join(f"({x} - CAST('{m[f'm_{c}']!r}' AS DOUBLE)) / CAST('{m[f's_{c}'] or 1.0!r}' AS DOUBLE) AS {c}_z"
                       for c, x in logs.items())
    stages = [SQLTransformer(statement=f"SELECT *, {scaled} FROM __THIS__")]
    cols = [f"{c}_z" for c in features]
    if one_hot:
        stages += [StringIndexer(inputCol=one_hot, outputCol=f"{one_hot}_ix", handleInvalid="keep"),
                   OneHotEncoder(inputCols=[f"{one_hot}_ix"], outputCols=[f"{one_hot}_oh"])]
        cols.append(f"{one_hot}_oh")
    stages.append(VectorAssembler(inputCols=cols, outputCol="features"))
    return Pipeline(stages=stages).fit(train)


def classifier(name: str, params: dict | None = None, n: int = 1, seed: int = 42):
    """One of the model families with ``params`` over its defaults; an inverse penalty ``C``
    on ``n`` rows is MLlib's regParam 1 / (C n)."""
    p = {**DEFAULTS[name], **(params or {})}
    io = {"featuresCol": "features", "labelCol": "label"}
    if name == "logistic_regression":
        return LogisticRegression(maxIter=2000, elasticNetParam=0.0, standardization=False,
                                  regParam=1.0 / (p["C"] * max(n, 1)), **io)
    trees = {"decision_tree": DecisionTreeClassifier, "random_forest": RandomForestClassifier,
             "gradient_boosting": GBTClassifier}
    # node ids are cached, or every round would send all trees grown so far to the tasks
    return trees[name](seed=seed, maxBins=MAX_BINS, maxMemoryInMB=1024, cacheNodeIds=True, **io, **p)


def grid(name: str) -> list[dict]:
    """Every point of the family's grid."""
    g = GRIDS[name]
    return [dict(zip(g, values)) for values in product(*g.values())]


def vectors(prep: PipelineModel, df: DataFrame, n: int, rows: int = ROWS_PER_PARTITION) -> DataFrame:
    """The label and vector of each row, cached in partitions of about ``rows`` rows."""
    return prep.transform(df).select("label", "features").repartition(max(1, math.ceil(n / rows))).cache()


class ForestParts(Transformer):
    """Forests fitted apart on the same rows, as one: its raw prediction is the sum over the trees of all parts."""

    def __init__(self, parts: Sequence):
        super().__init__()
        self.parts = list(parts)

    @property
    def featureImportances(self) -> list[float]:
        total = sum((m.featureImportances.toArray() * m.getNumTrees for m in self.parts))
        return (total / (total.sum() or 1.0)).tolist()

    def _transform(self, df: DataFrame) -> DataFrame:
        names = [f"_raw{i}" for i in range(len(self.parts))]
        out = df
        for name, m in zip(names, self.parts):
            out = m.copy().setRawPredictionCol(name).setProbabilityCol("").setPredictionCol("").transform(out)
        raw = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), [vector_to_array(c) for c in names])
        out = out.withColumn("_raw", raw).drop(*names)
        share = F.transform("_raw", lambda x: x / F.aggregate("_raw", F.lit(0.0), lambda a, b: a + b))
        top = (F.array_position("_raw", F.array_max("_raw")) - 1).cast("double")  # the first of equal classes
        return out.select(*df.columns, array_to_vector("_raw").alias("rawPrediction"),
                          array_to_vector(share).alias("probability"), top.alias("prediction"))


def grown_spec(x: DataFrame, n: int, name: str, params: dict, seed: int = 42, depths: Sequence[int] = (),
               sizes: Sequence[int] = ()) -> growing.Spec | None:
    """How the tree or forest on the ``n`` rows of ``x`` is grown inside the tasks; None where it is left to MLlib: on few
    rows, and on more than a task may hold."""
    if name not in NESTED_MODELS:
        return None
    p = DEFAULTS[name] | params
    features, trees = feature_count(x), p.get("numTrees", 1)
    if not features or n * features > growing.MOST_CELLS or n <= GROWN_ROWS and n * trees < GROWN_CELLS:
        return None
    tried = forests.tried(p["featureSubsetStrategy"], features) if name == "random_forest" else str(features)
    if not tried.isdigit() or not set(p) <= {"numTrees", "maxDepth", "minInstancesPerNode", "impurity", "featureSubsetStrategy"}:
        return None
    return growing.Spec(trees, p.get("maxDepth", 5), max(1, p.get("minInstancesPerNode", 1)), p.get("impurity", "gini"),
                        int(tried), name == "random_forest", seed, tuple(sorted(set(depths))), tuple(sorted(set(sizes))))


def feature_count(x: DataFrame) -> int | None:
    return x.schema["features"].metadata.get("ml_attr", {}).get("num_attrs")


def fit_forest(x: DataFrame, params: dict, n: int, seed: int = 42, parallelism: int = PARALLELISM):
    """The random forest on the ``n`` rows of ``x``; on many rows its trees are dealt over parts with seeds of their
    own, fitted several at a time, as MLlib grows the trees of one forest in the same few tasks."""
    trees = (DEFAULTS["random_forest"] | params)["numTrees"]
    count = min(parallelism, trees, math.ceil(n * trees / FOREST_PART))
    if count <= 1:
        return classifier("random_forest", params, n, seed).fit(x)

    def one(i):
        own = params | {"numTrees": trees // count + (i < trees % count)}
        return classifier("random_forest", own, n, seed + 1_000_003 * i).fit(x)
    return ForestParts(in_parallel(x.sparkSession, one, range(count), parallelism))


def fit_boosted(frames: Sequence[DataFrame], sizes: Sequence[int], params: dict, seed: int = 42) -> list[boosting.Boosted]:
    """Gradient-boosted trees with ``params`` over their defaults on each of the cached tables, grown in the same passes."""
    return boosting.fit(frames, sizes, seed=seed, bins=MAX_BINS, **DEFAULTS["gradient_boosting"] | params)


@dataclass
class Fold:
    train: DataFrame
    valid: DataFrame
    n: int  # training rows


@contextmanager
def fold_frames(train: DataFrame, features: Sequence[str] = BASE_FEATURES, one_hot: str | None = None,
                k: int = 5, rows: int = TREE_ROWS_PER_PARTITION) -> Iterator[list[Fold]]:
    """The k folds of ``train`` (column ``fold``) as cached vectors in partitions of about ``rows`` rows, scaled by
    each fold's own training rows; released at the end of the block."""
    sizes = {r["fold"]: r["count"] for r in train.groupBy("fold").count().collect()}  # k rows
    folds = []
    try:
        for f in range(k):
            rest = train.where(F.col("fold") != f)
            n = sum(c for g, c in sizes.items() if g != f)
            prep = preprocessing(rest, features, one_hot)
            folds.append(Fold(vectors(prep, rest, n, rows),
                              vectors(prep, train.where(F.col("fold") == f), sizes.get(f, 0)), n))
        yield folds
    finally:
        for f in folds:
            f.train.unpersist()
            f.valid.unpersist()


def trees_at_once(name: str, params: dict, n: int, parallelism: int = PARALLELISM) -> int:
    """Fits whose trees the driver holds at a time.  Single trees grow with their rows; a forest counts as before."""
    if name != "decision_tree":
        return parallelism
    least = max(1, params.get("minInstancesPerNode", 1))
    return max(1, min(parallelism, DEEP_ROWS * least // max(n, 1)))


def cross_validate(folds: list[Fold], name: str, points: Sequence[dict],
                   parallelism: int = PARALLELISM) -> list[list[float]]:
    """F1 of the positive class of every point in every fold.  Points of a tree family that differ only in depth
    and number of trees are read off one deep fit."""
    spark = folds[0].train.sparkSession
    if name in NESTED_MODELS:
        features = feature_count(folds[0].train)
        groups = [(params, places, i) for params, places in forests.nested_groups(points, features) for i in range(len(folds))]

        def wanted(places):
            return [(points[p].get("maxDepth", DEFAULTS[name].get("maxDepth", MAX_DEPTH)),
                     points[p].get("numTrees", DEFAULTS[name].get("numTrees", 1))) for p in places]

        def whole(job):
            params, places, i = job
            model = classifier(name, params, folds[i].n).fit(folds[i].train)
            own = wanted(places)
            counts = forests.nested_counts(model, folds[i].valid, sorted({d for d, _ in own}), sorted({m for _, m in own}))
            return [(p, i, forests.f1(counts[o])) for p, o in zip(places, own)]
        at_once = lambda job: trees_at_once(name, job[0], folds[job[2]].n, parallelism)
        scores = [[0.0] * len(folds) for _ in points]
        specs = [grown_spec(folds[i].train, folds[i].n, name, params, depths=[d for d, _ in wanted(places)],
                            sizes=[m for _, m in wanted(places)]) for params, places, i in groups]
        if specs and all(specs):
            found = growing.counts([(f.train, f.valid) for f in folds], [f.n for f in folds],
                                   [(i, spec) for (*_, i), spec in zip(groups, specs)], features, MAX_BINS)
            for (_, places, i), counts in zip(groups, found):
                for p, own in zip(places, wanted(places)):
                    scores[p][i] = forests.f1(counts[own])
            return scores
        for width in sorted({at_once(job) for job in groups}):
            for found in in_parallel(spark, whole, [job for job in groups if at_once(job) == width], width):
                for p, i, f1 in found:
                    scores[p][i] = f1
        return scores

    def one(job):
        params, f = job
        model = classifier(name, params, f.n).fit(f.train)
        return E.metrics(model.transform(f.valid)).first()["f1"]
    if name == "gradient_boosting":  # the folds of a point share their passes
        scores = []
        for p in points:
            models = fit_boosted([f.train for f in folds], [f.n for f in folds], p)
            scores.append(in_parallel(spark, lambda mf: E.metrics(mf[0].transform(mf[1].valid)).first()["f1"],
                                      list(zip(models, folds)), parallelism))
        return scores
    flat = in_parallel(spark, one, [(p, f) for p in points for f in folds], parallelism)
    return [flat[i:i + len(folds)] for i in range(0, len(flat), len(folds))]


def tune(train: DataFrame, name: str, features: Sequence[str] = BASE_FEATURES, k: int = 5,
         parallelism: int = PARALLELISM, points: Sequence[dict] | None = None):
    """Grid search over the folds of ``train``; returns (pipeline refitted on all training
    rows with the best point, that point, its F1 in each fold).  Ties go to the earlier point."""
    points = list(points or grid(name))
    with fold_frames(train, features, k=k) as folds:
        scores = cross_validate(folds, name, points, parallelism)
    best = max(range(len(points)), key=lambda i: sum(scores[i]))
    return fit_with(train, name, points[best], features), points[best], scores[best]


def fit_with(train: DataFrame, name: str, params: dict, features: Sequence[str] = BASE_FEATURES,
             one_hot: str | None = None, parallelism: int = PARALLELISM) -> PipelineModel:
    """Fit one configuration (params by name) on ``train``; a large forest in parts, ``parallelism`` of them at most."""
    n = train.count()
    prep = preprocessing(train, features, one_hot)
    x = vectors(prep, train, n, TREE_ROWS_PER_PARTITION if name in NESTED_MODELS else ROWS_PER_PARTITION)
    try:
        if name == "gradient_boosting":
            model, = fit_boosted([x], [n], params)
        elif spec := grown_spec(x, n, name, params):
            model = growing.fit(x, n, spec, feature_count(x), MAX_BINS)
        else:
            model = fit_forest(x, params, n, parallelism=parallelism) if name == "random_forest" else classifier(name, params, n).fit(x)
        return PipelineModel(prep.stages + [model])
    finally:
        x.unpersist()


def score(model, df: DataFrame, name: str) -> DataFrame:
    """Probability of the positive class (4 dp), class at 0.5, actual, split, correct."""
    p = model.transform(df)
    p1 = vector_to_array("probability")[1]
    return p.select("customer_id", (p1 >= 0.5).cast("int").alias("predicted"), F.round(p1, 4).alias("probability"),
                    F.col("label").alias("actual"), F.round("future_spend", 2).alias("actual_future_spend"),
                    F.when(F.col("split") == "test", F.lit("held-out test")).otherwise(F.lit("train")).alias("data_split"),
                    F.lit(name).alias("model")) \
        .withColumn("correct", F.col("predicted") == F.col("actual"))


def importances(spark: SparkSession, fitted: dict, features: Sequence[str] = BASE_FEATURES) -> DataFrame:
    """Long table (model, feature, importance, type)."""
    rows = []
    for name, pm in fitted.items():
        clf = pm.stages[-1]
        if name == "logistic_regression":
            rows += [(name, f, float(v), "standardised_coefficient") for f, v in zip(features, clf.coefficients)]
        elif hasattr(clf, "featureImportances"):
            rows += [(name, f, float(v), "impurity_importance") for f, v in zip(features, clf.featureImportances)]
    return spark.createDataFrame(rows, "model string, feature string, importance double, type string")


def decision_record(spark: SparkSession, summary: dict) -> DataFrame:
    """One-row JSON decision record (values computed, not typed in)."""
    return spark.createDataFrame([(json.dumps(summary, sort_keys=True),)], "record string")


def curve_steps(train: DataFrame, fractions: Sequence[float]) -> DataFrame:
    """``train`` with ``step``, the first of the rising ``fractions`` whose subset holds the row (null: none).

    A subset holds of each fold the customers with the smallest hashes, up to the exact quantile of the
    fraction: floor((n - 1) fraction) + 1 of n (equal hashes fall on the same side)."""
    drawn = materialize(train.withColumn("_u", unit_hash(F.col("customer_id"), seed="curve")))
    cuts = [f"_cut{i}" for i in range(len(fractions))]
    at = drawn.join(F.broadcast(quantiles(drawn, "_u", fractions, by=["fold"], names=cuts)), "fold")  # one row a fold
    step = F.coalesce(*[F.when(F.col("_u") <= F.col(c), F.lit(i)) for i, c in enumerate(cuts)])
    return at.withColumn("step", step).select(*train.columns, "step")


def learning_curve(train: DataFrame, name: str, params: dict, fractions: Sequence[float],
                   features: Sequence[str] = BASE_FEATURES, k: int = 5, parallelism: int = PARALLELISM):
    """(fraction, fold, train accuracy, validation accuracy) of nested training subsets (``curve_steps``)."""
    fractions = sorted(fractions)
    train = materialize(curve_steps(train, fractions))

    def accuracy(model, df):
        return E.metrics(model.transform(df)).first()["accuracy"]

    def one(job):
        fraction, f = job
        subset = train.where((F.col("fold") != f) & (F.col("step") <= fractions.index(fraction)))
        model = fit_with(subset, name, params, features, parallelism=1)  # the other fits of the curve use the cores
        return fraction, f, accuracy(model, subset), accuracy(model, train.where(F.col("fold") == f))
    return in_parallel(train.sparkSession, one, [(fr, f) for fr in fractions for f in range(k)], parallelism)
