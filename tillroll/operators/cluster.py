"""Clustering fits.

K-means configurations (k values, restarts, resamples, tables) are fitted
together, a pass over the rows moving all of them (``batch_kmeans``); the other
algorithms are MLlib's.  Of the restarts the one with the lowest cost is kept, as
with ``n_init``.  Resampling for stability uses Poisson(1) weights derived from a
hash of (id, replicate), so a replicate is reproducible and needs no shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.clustering import BisectingKMeans, GaussianMixture
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import unit_hash
from ..session import in_parallel, materialize
from . import batch_kmeans as B
from . import validity as K
from .density import placed_dbscan


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out).transform(df)


class KMeansFit:
    """Centres of the cheapest restart; ``transform`` adds the nearest centre as ``cluster``."""

    def __init__(self, fit: B.Fit, features: str):
        self.fit, self.features = fit, features
        self.cost, self.centres = fit.cost, fit.centres

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("cluster", self.fit.cluster(vector_to_array(F.col(self.features))))


def restarts(key, table: str, k: int, n_init: int, seed: int, weight: int | None = None) -> list[B.Run]:
    return [B.Run(key, table, k, seed + r, weight) for r in range(n_init)]


def _arrays(df: DataFrame, features: str, weights: Column | None = None) -> DataFrame:
    cols = [vector_to_array(F.col(features)).alias("x"), *([weights.alias("w")] if weights is not None else [])]
    return materialize(df.select(*cols))


def fit_kmeans(df: DataFrame, k: int, n_init: int = 10, seed: int = 42, max_iter: int = 300,
               features: str = "features") -> KMeansFit:
    """The cheapest of ``n_init`` restarts (lowest within-cluster cost), all fitted in the same passes."""
    fits = B.fit_all(_arrays(df, features), restarts(0, "x", k, n_init, seed), max_iter=max_iter)
    return KMeansFit(B.best_of(fits)[0], features)


def sweep(df: DataFrame, tables: Sequence[str], ks: Sequence[int], n_init: int = 10, seed: int = 42) -> list[tuple]:
    """(table, k, WCSS, silhouette) of the best restart for every table (an array column of ``df``) and k."""
    runs = [r for t in tables for k in ks for r in restarts((t, k), t, k, n_init, seed)]
    best = B.best_of(B.fit_all(df, runs))
    scores = B.silhouettes(df, best)
    return [(t, int(k), best[t, k].cost, scores[t, k]) for t in tables for k in ks]


def silhouette(df: DataFrame, features: str = "features", pred: str = "cluster") -> float:
    """Squared-Euclidean silhouette (MLlib evaluator; O(n k))."""
    return ClusteringEvaluator(featuresCol=features, predictionCol=pred,
                               distanceMeasure="squaredEuclidean").evaluate(df)


def k_sweep(spark: SparkSession, df: DataFrame, ks: Sequence[int] = range(2, 11), n_init: int = 10,
            seed: int = 42, features: str = "features") -> DataFrame:
    """K, WCSS of the best restart, silhouette of its assignment."""
    rows = [r[1:] for r in sweep(_arrays(df, features), ["x"], ks, n_init, seed)]
    return spark.createDataFrame(rows, "k int, wcss double, silhouette_sq double")


def poisson1_weight(id_col: Column, replicate: int, seed: int = 1000) -> Column:
    """Poisson(1) draw from u = hash(id, replicate) by inverse CDF (bootstrap weight)."""
    u = unit_hash(id_col, seed=f"boot{seed + replicate}")
    cdf, p, expr = 0.0, math.exp(-1.0), None
    for n in range(0, 12):
        cdf += p
        cond = u < F.lit(cdf)
        expr = F.when(cond, F.lit(float(n))) if expr is None else expr.when(cond, F.lit(float(n)))
        p = p / (n + 1)
    return expr.otherwise(F.lit(12.0))


def ari(df: DataFrame, a: str, b: str) -> float:
    return float(K.adjusted_rand(df, a, b).first()["ari"])


def bootstrap_stability(spark: SparkSession, df: DataFrame, base: KMeansFit, k: int, id_col: str, b_reps: int = 20,
                        n_init: int = 10, seed: int = 42, features: str = "features") -> DataFrame:
    """Per replicate, refit on Poisson-weighted rows and compare the refit's assignment with the base
    assignment on the drawn rows (ARI).  All replicates and restarts are fitted in the same passes."""
    x = _arrays(df, features, F.array(*[poisson1_weight(F.col(id_col), b) for b in range(b_reps)]))
    runs = [r for b in range(b_reps) for r in restarts(b, "x", k, n_init, seed, b)]
    found = B.adjusted_rands(x, base.fit, B.best_of(B.fit_all(x, runs, weights="w")), weights="w")
    return spark.createDataFrame(sorted(found.items()), "replicate int, ari double")


def seed_stability(spark: SparkSession, df: DataFrame, base: KMeansFit, k: int, seeds: Sequence[int] = (7, 13, 21, 99, 123),
                   n_init: int = 10, features: str = "features") -> DataFrame:
    """Refit with other seeds, no restart shared between two of them; ARI against the base assignment."""
    x = _arrays(df, features)
    runs = [r for s in seeds for r in restarts(s, "x", k, n_init, 1000 * s)]
    found = B.adjusted_rands(x, base.fit, B.best_of(B.fit_all(x, runs)))
    return spark.createDataFrame([(int(s), found[s]) for s in seeds], "seed int, ari double")


def stability_summary(df: DataFrame) -> DataFrame:
    """mean / population sd / min of the ARI column."""
    return df.agg(F.avg("ari").alias("ari_mean"), F.stddev_pop("ari").alias("ari_sd"), F.min("ari").alias("ari_min"),
                  F.count(F.lit(1)).alias("fits"))


def validity_row(pred: DataFrame, id_col: str, features: str = "features", cluster: str = "cluster") -> dict:
    """Silhouette (squared), Davies-Bouldin, Calinski-Harabasz of one labelling."""
    return point_indices(pred.select(F.col(id_col), F.col(cluster).alias("cluster"),
                                     vector_to_array(F.col(features)).alias("x")), id_col)


def point_indices(points: DataFrame, id_col: str) -> dict:
    """``validity_row`` of points with their coordinates as an array ``x``."""
    pts = K.vector_points(points, id_col, "x", "cluster").cache()
    try:
        prof = K.profiles(pts)
        out = {"silhouette_sq": float(K.silhouette_score_sq(pts, prof).first()["silhouette_sq"]),
               "davies_bouldin": K.davies_bouldin(pts, prof).first()["davies_bouldin"],
               "calinski_harabasz": K.calinski_harabasz(pts, prof).first()["calinski_harabasz"]}
    finally:
        pts.unpersist()
    return out


ALGORITHMS = ("kmeans", "gaussian_mixture", "bisecting_kmeans")


def algorithm_comparison(spark: SparkSession, df: DataFrame, id_col: str, ks: Sequence[int] = (3, 4, 5),
                         seed: int = 42, features: str = "features", n_init: int = 10,
                         algorithms: Sequence[str] = ALGORITHMS) -> DataFrame:
    """K-means vs Gaussian mixture vs bisecting k-means
    (the distributed stand-in for Ward linkage) over ``ks``, three indices each."""
    def kmeans(own):
        runs = [r for k in own for r in restarts(k, "x", k, n_init, seed)]
        return {k: KMeansFit(f, features) for k, f in B.best_of(B.fit_all(_arrays(df, features), runs)).items()}
    make = {
        "kmeans": kmeans,
        "gaussian_mixture": lambda own: {k: GaussianMixture(k=k, seed=seed, featuresCol=features, predictionCol="cluster",
                                                            probabilityCol="_prob").fit(df) for k in own},
        "bisecting_kmeans": lambda own: {k: BisectingKMeans(k=k, seed=seed, featuresCol=features, predictionCol="cluster").fit(df)
                                         for k in own},
    }

    def rows(job):
        name, own = job
        fits, out = make[name](own), {}
        for k in own:
            pred = fits[k].transform(df)
            n_clusters = pred.select("cluster").distinct().count()
            v = validity_row(pred, id_col, features) if n_clusters > 1 else \
                {"silhouette_sq": None, "davies_bouldin": None, "calinski_harabasz": None}
            out[k, name] = name, int(k), int(n_clusters), v["silhouette_sq"], v["davies_bouldin"], v["calinski_harabasz"]
        return out
    # the k-means fits of all k move in the same passes; MLlib's are fits of their own
    jobs = [(name, own) for name in algorithms for own in ([list(ks)] if name == "kmeans" else [[k] for k in ks])]
    found = {key: r for part in in_parallel(spark, rows, jobs) for key, r in part.items()}
    return spark.createDataFrame([found[k, name] for k in ks for name in algorithms],
                                 "algorithm string, k int, clusters int, silhouette_sq double, "
                                 "davies_bouldin double, calinski_harabasz double")


def dbscan_rows(spark: SparkSession, df: DataFrame, id_col: str, cols: Sequence[str], eps_list: Sequence[float],
                min_samples: int = 10) -> DataFrame:
    """Per eps the number of DBSCAN clusters, of clustered points and of noise, and the three indices of the
    clustered points (null for fewer than two clusters)."""
    def row(eps):
        found = materialize(placed_dbscan(df, id_col, cols, eps, min_samples))
        clusters, clustered, noise = found.agg(F.countDistinct("cluster"), F.count("cluster"), F.count_if(F.col("cluster").isNull())).first()
        v = {"silhouette_sq": None, "davies_bouldin": None, "calinski_harabasz": None}
        if clusters > 1:
            v = point_indices(found.where("cluster IS NOT NULL")
                              .select("id", "cluster", F.array(*[f"x{i}" for i in range(len(cols))]).alias("x")), "id")
        return "dbscan", float(eps), int(clusters), int(clustered), int(noise), *v.values()
    rows = in_parallel(spark, row, eps_list)
    return spark.createDataFrame(rows, "algorithm string, eps double, clusters int, clustered long, noise long, silhouette_sq double, "
                                       "davies_bouldin double, calinski_harabasz double")


def pca_projection(spark: SparkSession, df: DataFrame, dims: Sequence[int] = (2, 3), k: int = 4, seed: int = 42,
                   features: str = "features", n_init: int = 10) -> DataFrame:
    """PCA to 2 and 3 components, explained variance, k-means silhouette there."""
    rows = []
    for d in dims:
        model = PCA(k=d, inputCol=features, outputCol="_pc").fit(df)
        proj = model.transform(df)
        km = fit_kmeans(proj, k, n_init, seed, features="_pc")
        rows.append((int(d), float(sum(model.explainedVariance.toArray())),
                     silhouette(km.transform(proj), "_pc")))
    return spark.createDataFrame(rows, "components int, explained_variance double, silhouette_sq double")
