import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.operators import cluster as CL
from tillroll.operators import validity as K


def blobs(n_per=100, seed=3):
    rng = np.random.default_rng(seed)
    centres = np.array([[0, 0, 0], [8, 0, 0], [0, 8, 0], [0, 0, 8]], dtype=float)
    pts, lab = [], []
    for i, c in enumerate(centres):
        pts.append(c + rng.normal(0, 1, (n_per, 3)))
        lab += [i] * n_per
    return np.vstack(pts), np.array(lab)


@pytest.fixture(scope="module")
def fixture(spark):
    x, lab = blobs()
    rows = [(i, int(lab[i]), [float(v) for v in x[i]]) for i in range(len(x))]
    return spark.createDataFrame(rows, "id long, cluster int, x array<double>"), x, lab


def brute_silhouette_sq(x, lab):
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)
    s = []
    for i in range(len(x)):
        own = lab == lab[i]
        a = d[i, own & (np.arange(len(x)) != i)].mean()
        b = min(d[i, lab == c].mean() for c in set(lab) if c != lab[i])
        s.append((b - a) / max(a, b))
    return float(np.mean(s))


def test_closed_form_silhouette_equals_brute_force(fixture):
    df, x, lab = fixture
    pts = K.vector_points(df, "id", "x")
    got = K.silhouette_score_sq(pts).first()["silhouette_sq"]
    assert abs(got - brute_silhouette_sq(x, lab)) < 1e-9
    assert -1 <= got <= 1


def test_davies_bouldin_and_calinski_harabasz(fixture):
    df, x, lab = fixture
    pts = K.vector_points(df, "id", "x")
    k = 4
    mu = np.array([x[lab == c].mean(0) for c in range(k)])
    s = np.array([np.linalg.norm(x[lab == c] - mu[c], axis=1).mean() for c in range(k)])
    db = np.mean([max((s[i] + s[j]) / np.linalg.norm(mu[i] - mu[j]) for j in range(k) if j != i) for i in range(k)])
    g = x.mean(0)
    b = sum((lab == c).sum() * ((mu[c] - g) ** 2).sum() for c in range(k))
    w = sum(((x[lab == c] - mu[c]) ** 2).sum() for c in range(k))
    ch = (b / (k - 1)) / (w / (len(x) - k))
    assert abs(K.davies_bouldin(pts).first()[0] - db) < 1e-9
    assert abs(K.calinski_harabasz(pts).first()[0] - ch) < 1e-6 * ch
    assert abs(K.wcss(pts).agg(F.sum("wcss")).first()[0] - w) < 1e-6


def test_ari_relabelling_invariant(spark):
    df = spark.createDataFrame([(i % 4, (i % 4 + 1) % 4) for i in range(100)], "a int, b int")
    assert abs(K.adjusted_rand(df, "a", "b").first()["ari"] - 1.0) < 1e-12


def test_kmeans_recovers_planted_blobs(spark, fixture):
    df, _, _ = fixture
    from pyspark.ml.functions import array_to_vector
    v = df.select("id", F.col("cluster").alias("truth"), array_to_vector("x").alias("features"))
    m = CL.fit_kmeans(v, 4, n_init=2)
    pred = m.transform(v)
    assert CL.ari(pred, "truth", "cluster") > 0.99


def test_poisson_weights_mean_one(spark):
    df = spark.range(20000).select(CL.poisson1_weight(F.col("id"), 3).alias("w"))
    r = df.agg(F.avg("w"), F.variance("w")).first()
    assert abs(r[0] - 1) < 0.03 and abs(r[1] - 1) < 0.05


def test_k_sweep_wcss_non_increasing_and_peaks_at_planted_k(spark, fixture):
    df, _, _ = fixture
    from pyspark.ml.functions import array_to_vector
    v = df.select("id", array_to_vector("x").alias("features")).cache()
    rows = {r.k: r for r in CL.k_sweep(spark, v, range(2, 7), n_init=3).collect()}
    w = [rows[k].wcss for k in range(2, 7)]
    assert all(a >= b - 1e-9 for a, b in zip(w, w[1:]))
    assert max(rows, key=lambda k: rows[k].silhouette_sq) == 4
    v.unpersist()


@pytest.mark.parametrize("eps", [0.6, 1.5])
def test_density_labels_match_brute_force(spark, eps):
    from tillroll.operators import density as DN
    x, _ = blobs(n_per=60, seed=8)
    rng = np.random.default_rng(2)
    x = np.vstack([x, rng.uniform(-4, 12, (40, 3))])          # scattered noise points
    rows = [(i, *map(float, x[i])) for i in range(len(x))]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    got = {r.id: r.label for r in DN.density_labels(df, "id", ["a", "b", "c"], eps, 10).collect()}
    d2 = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)
    within = d2 <= eps * eps
    core = within.sum(1) >= 10
    border = ~core & (within & core[None, :]).any(1)
    want = {i: "core" if core[i] else ("border" if border[i] else "noise") for i in range(len(x))}
    assert got == want


def brute_silhouette(x, lab, chosen):
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    s = []
    for i in chosen:
        own = lab == lab[i]
        if own.sum() == 1:
            s.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, lab == c].mean() for c in set(lab) if c != lab[i])
        s.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return s


def test_euclidean_silhouette_equals_brute_force(spark):
    x, lab = blobs()
    x[:140] = x[0] + 100  # a third of the rows is one point, in two clusters
    x, lab = np.vstack([x, [[50.0, 50.0, 50.0]]]), np.append(lab, 9)
    rows = [(i, int(lab[i]), [float(v) for v in x[i]]) for i in range(len(x))]
    rows += [(1000, None, [0.0, 0.0, 0.0]), (1050, 1, None)]
    pts = K.vector_points(spark.createDataFrame(rows, "id long, cluster int, x array<double>"), "id", "x")
    chosen = range(0, len(x), 5)
    for sizes in ({}, {"chosen_rows": 7, "point_rows": 40}):
        got = {r["id"]: r["s"] for r in K.silhouette_euclidean(pts, F.col("id") % 5 == 0, **sizes).collect()}
        assert sorted(got) == list(chosen)
        assert [got[i] for i in chosen] == pytest.approx(brute_silhouette(x, lab, chosen), abs=1e-9)
    assert K.silhouette_euclidean(pts.limit(0)).collect() == []


def test_validity_in_several_profile_blocks(fixture, monkeypatch):
    df, x, lab = fixture
    pts = K.vector_points(df, "id", "x")
    names = (K.wcss, K.silhouette_score_sq, K.davies_bouldin, K.calinski_harabasz)
    whole = [sorted(tuple(r) for r in f(pts).collect()) for f in names]
    monkeypatch.setattr(K, "PROFILE_ENTRIES", 5)
    for f, rows in zip(names, whole):
        for r, w in zip(sorted(tuple(r) for r in f(pts).collect()), rows):
            assert r == pytest.approx(w, rel=1e-12)


def test_validity_moves_no_points(fixture):
    pts = K.vector_points(fixture[0], "id", "x")
    for f in (K.wcss, K.silhouette_score_sq, K.davies_bouldin, K.calinski_harabasz):
        plan = f(pts)._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(id" not in plan and "hashpartitioning(x" not in plan
