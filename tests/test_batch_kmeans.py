"""k-means over many configurations at once, against separate fits and brute force."""
import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from test_validity_cluster import blobs, brute_silhouette_sq
from tillroll.operators import batch_kmeans as B
from tillroll.operators import cluster as CL
from tillroll.operators import validity as K
from tillroll.session import materialize


@pytest.fixture(scope="module")
def planted(spark):
    x, lab = blobs(60, seed=5)
    rows = [(i, int(lab[i]), x[i].tolist(), x[i, :2].tolist()) for i in range(len(x))]
    df = materialize(spark.createDataFrame(rows, "id long, truth int, x array<double>, flat array<double>").repartition(3))
    return df.withColumn("features", array_to_vector("x")), x, lab


def test_costs_are_no_worse_than_separate_fits(planted):
    df, x, _ = planted
    runs = [r for k in (2, 4, 6) for r in CL.restarts(k, "x", k, 10, 42)] + CL.restarts("flat", "flat", 3, 5, 1)
    fits = B.best_of(B.fit_all(df, runs))
    for k in (2, 4, 6):
        separate = min(KMeans(k=k, seed=s, maxIter=300).fit(df).summary.trainingCost for s in range(3))
        assert fits[k].cost <= separate * 1.0001
        near = ((x[:, None] - fits[k].centres) ** 2).sum(-1)
        assert fits[k].cost == pytest.approx(near.min(1).sum())
        got = {r["id"]: r["c"] for r in df.select("id", fits[k].cluster(F.col("x")).alias("c")).collect()}
        assert [got[i] for i in range(len(x))] == near.argmin(1).tolist()
    assert fits["flat"].centres.shape == (3, 2)


def test_silhouettes_against_brute_force(planted):
    df, x, _ = planted
    fits = B.best_of(B.fit_all(df, [B.Run(k, "x", k, 3) for k in (1, 2, 4, 9)]))
    got = B.silhouettes(df, fits)
    for k in (2, 4, 9):
        lab = ((x[:, None] - fits[k].centres) ** 2).sum(-1).argmin(1)
        assert got[k] == pytest.approx(brute_silhouette_sq(x, lab))
    assert got[1] is None


def test_weights_and_adjusted_rand(planted):
    df, x, _ = planted
    w = df.withColumn("w", F.array(F.lit(1.0), (F.col("id") % 3).cast("double")))
    fits = B.best_of(B.fit_all(w, [B.Run("all", "x", 4, 9), *CL.restarts("some", "x", 3, 3, 9, weight=1)], weights="w"))
    weight = np.arange(len(x)) % 3
    near = ((x[:, None] - fits["some"].centres) ** 2).sum(-1)
    assert fits["some"].cost == pytest.approx((weight * near.min(1)).sum())
    lab = near.argmin(1)
    for c in range(3):
        own = (lab == c) & (weight > 0)
        assert np.allclose(np.average(x[own], axis=0, weights=weight[own]), fits["some"].centres[c], atol=1e-3)
    got = B.adjusted_rands(w, fits["all"], fits, weights="w")
    pairs = w.select(fits["all"].cluster(F.col("x")).alias("a"), fits["some"].cluster(F.col("x")).alias("b"), "id")
    want = K.adjusted_rand(pairs.where("id % 3 > 0"), "a", "b").first()["ari"]
    assert got["all"] == 1.0 and got["some"] == pytest.approx(want)


def test_bootstrap_and_seed_stability_of_planted_blobs(spark, planted):
    df, _, _ = planted
    base = CL.fit_kmeans(df, 4, n_init=3)
    boot = CL.bootstrap_stability(spark, df, base, 4, "id", b_reps=4, n_init=3).collect()
    assert [r["replicate"] for r in boot] == [0, 1, 2, 3] and min(r["ari"] for r in boot) > 0.95
    seeds = CL.seed_stability(spark, df, base, 4, seeds=(7, 13), n_init=3).collect()
    assert [r["seed"] for r in seeds] == [7, 13] and min(r["ari"] for r in seeds) > 0.99
    noise = CL.bootstrap_stability(spark, df, CL.fit_kmeans(df, 9, n_init=1), 9, "id", b_reps=4, n_init=1).collect()
    assert np.mean([r["ari"] for r in noise]) < 0.95


def test_odd_tables(spark):
    same = materialize(spark.createDataFrame([([1.0, 2.0],)] * 5, "x array<double>"))
    fit = B.fit_all(same, [B.Run(0, "x", 3, 1)])[0]
    assert fit.cost == 0 and B.silhouettes(same, {0: fit})[0] is None
    with pytest.raises(ValueError):
        B.fit_all(same.limit(0), [B.Run(0, "x", 2, 1)])


def test_rows_in_one_partition_are_spread(planted, monkeypatch):
    df, x, _ = planted
    one = materialize(df.coalesce(1))
    parts = []

    def counted(rows, *rest, inner=B._sums):
        parts.append(rows.rdd.getNumPartitions())
        return inner(rows, *rest)
    monkeypatch.setattr(B, "_sums", counted)
    monkeypatch.setattr(B, "CELLS", 100)
    fits = B.best_of(B.fit_all(one, CL.restarts(4, "x", 4, 3, 42)))
    got = B.silhouettes(one, fits)
    assert min(parts) > 1
    near = ((x[:, None] - fits[4].centres) ** 2).sum(-1)
    assert fits[4].cost == pytest.approx(near.min(1).sum())
    assert got[4] == pytest.approx(brute_silhouette_sq(x, near.argmin(1)))
