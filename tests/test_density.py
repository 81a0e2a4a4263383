"""DBSCAN against brute force, and components against a union-find."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from test_validity_cluster import blobs, brute_silhouette_sq
from tillroll.operators import cluster as CL
from tillroll.operators import density as DN
from tillroll.operators.components import components


def brute_dbscan(x, ids, eps, m):
    d2 = ((x[:, None] - x[None]) ** 2).sum(-1)
    within = d2 <= eps * eps
    core = within.sum(1) >= m
    name = {i: ids[i] for i in range(len(x)) if core[i]}
    moved = True
    while moved:
        moved = False
        for i in name:
            least = min(name[j] for j in name if within[i, j])
            if least < name[i]:
                name[i], moved = least, True
    out = {}
    for i in range(len(x)):
        near = [name[j] for j in name if within[i, j]]
        out[ids[i]] = ("core", name[i]) if core[i] else ("border", min(near)) if near else ("noise", None)
    return out


def check(spark, x, eps, m=10):
    ids = np.random.default_rng(4).permutation(len(x)).tolist()
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in zip(ids, x)], "id long, " + ", ".join(f"k{j} double" for j in range(x.shape[1])))
    got = {r["id"]: (r["label"], r["cluster"]) for r in DN.dbscan(df, "id", df.columns[1:], eps, m).collect()}
    assert got == brute_dbscan(x, ids, eps, m)
    return got


@pytest.mark.parametrize("eps", [0.9, 1.4])
def test_clusters_match_brute_force(spark, eps):
    x, _ = blobs(50, seed=8)
    x = np.vstack([x, np.random.default_rng(2).uniform(-4, 12, (40, 3))])
    assert {"core", "noise"} <= {v[0] for v in check(spark, x, eps).values()}


def test_a_hot_cell_and_its_neighbours(spark):
    rng = np.random.default_rng(6)
    hot = np.r_[rng.uniform(0, 0.3, (150, 2)), np.full((40, 2), 0.1)]
    near = np.c_[rng.uniform(1.2, 1.35, 40), rng.uniform(0, 0.3, 40)]  # some within eps of the hot cell, some not
    far = rng.uniform(3, 9, (12, 2))
    x = np.vstack([hot, near, far, [[0.3, 1.25], [1.0, 1.0]]])
    for eps in (1.0, 0.95, 0.9):
        check(spark, x, eps)


def test_odd_points(spark):
    empty = spark.createDataFrame([], "id long, a double, b double")
    assert DN.dbscan(empty, "id", ["a", "b"], 1.0).count() == 0
    check(spark, np.zeros((12, 2)), 0.5)
    check(spark, np.array([[0.0], [1.0], [2.0], [5.0]]), 1.0, 2)  # distances equal to eps count


def test_components_of_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(60)]
    hub = [(100, 101 + i) for i in range(40)]
    loops = [(7, 7), (500, 500), (201, 200), (200, 201)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(chain + hub + loops, "u long, v long")).collect()}
    want = {i: 0 for i in range(61)} | {100: 100} | {101 + i: 100 for i in range(40)} | {200: 200, 201: 200}
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_comparison_rows(spark):
    x, lab = blobs(30, seed=1)
    x = np.vstack([x, [[30.0, 30.0, 30.0]]])
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(x)], "id long, a double, b double, c double")
    some, one = CL.dbscan_rows(spark, df, "id", ["a", "b", "c"], [2.5, 100.0], 5).collect()
    kept = [i for i, v in brute_dbscan(x, list(range(len(x))), 2.5, 5).items() if v[1] is not None]
    own = brute_dbscan(x, list(range(len(x))), 2.5, 5)
    assert (some["clusters"], some["noise"]) == (len({own[i][1] for i in kept}), len(x) - len(kept))
    assert some["silhouette_sq"] == pytest.approx(brute_silhouette_sq(x[kept], np.array([own[i][1] for i in kept])))
    assert one["clusters"] == 1 and one["noise"] == 0 and one["silhouette_sq"] is None


def test_dense_cells_are_not_counted_point_by_point(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = np.vstack([rng.uniform(0, 0.5, (40, 2)), rng.uniform(6.4, 6.9, (40, 2))])
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(x)], "id long, a double, b double")
    want = brute_dbscan(x, list(range(80)), 1.0, 10)

    def no_probes(*_):
        raise AssertionError("no cell has few points and every point is core")
    monkeypatch.setattr(DN, "_hits", no_probes)
    got = {r["id"]: r for r in DN.placed_dbscan(df, "id", ["a", "b"], 1.0).collect()}
    assert {i: (r["label"], r["cluster"]) for i, r in got.items()} == want
    assert all((r["x0"], r["x1"]) == tuple(x[i]) for i, r in got.items())
    core = DN._cells(df, "id", ["a", "b"], 0.7)
    plan = DN._boxes(core, 2, 0.7, 0, [F.first("x0").alias("one0")])._jdf.queryExecution().toString()
    assert "SortAggregate" not in plan


def test_k_means_of_all_k_share_their_passes(spark, monkeypatch):
    x, _ = blobs(30, seed=3)
    df = CL.assemble(spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(x)], "id long, a double, b double, c double"), ["a", "b", "c"])
    calls, fit_all = [], CL.B.fit_all
    monkeypatch.setattr(CL.B, "fit_all", lambda *a, **k: calls.append(1) or fit_all(*a, **k))
    rows = CL.algorithm_comparison(spark, df, "id", (2, 3), n_init=2, algorithms=["kmeans", "bisecting_kmeans"]).collect()
    assert [(r["algorithm"], r["k"]) for r in rows] == [("kmeans", 2), ("bisecting_kmeans", 2), ("kmeans", 3), ("bisecting_kmeans", 3)]
    assert len(calls) == 1
    apart = CL.fit_kmeans(df, 3, 2)
    assert rows[2]["silhouette_sq"] == pytest.approx(CL.silhouette(apart.transform(df)))
