"""Cluster validity.

A point is one row ``(id, cluster, x)`` with its whole vector; ``id`` names the
row, and rows without cluster or vector are left out.  Points never move:
the clusters' profiles (size, centroid, mean squared norm) come from sums by
(cluster, coordinate), and every distance to a centroid is computed inside the
row.  Profiles are broadcast in blocks of at most ``PROFILE_ENTRIES``
coordinates; more clusters than one block holds take one pass for each block.

The plain Euclidean silhouette needs all distances of a row.  It is computed
for a stated set of rows against all rows, as sums over a grid of blocks.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

# workers need not have this package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Coordinates of centroids in one broadcast (8 MB of doubles).
PROFILE_ENTRIES = 1_000_000
#: Copies of each profile when all of them together are too large for a broadcast.
SALTS = 64
#: Rows of a grid cell of the Euclidean silhouette: chosen rows, and distinct points.
CHOSEN_ROWS, POINT_ROWS = 2_000, 50_000


def vector_points(df: DataFrame, id_col: str, vec_col: str, cluster_col: str = "cluster") -> DataFrame:
    return (df.select(F.col(id_col).alias("id"), F.col(cluster_col).alias("cluster"),
                      F.col(vec_col).cast("array<double>").alias("x"))
            .where("cluster IS NOT NULL AND x IS NOT NULL"))


def column_points(df: DataFrame, id_col: str, cols: Sequence[str], cluster_col: str = "cluster") -> DataFrame:
    arr = F.array(*[F.col(c).cast("double") for c in cols])
    return vector_points(df.select(F.col(id_col).alias("id"), F.col(cluster_col).alias("cluster"), arr.alias("x")),
                         "id", "x")


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, v: s + v)


def _dot(a: Column, b: Column) -> Column:
    return _total(F.zip_with(a, b, lambda u, v: u * v))


def _sq_distance(a: Column, b: Column) -> Column:
    return _total(F.zip_with(a, b, lambda u, v: (u - v) * (u - v)))


def profiles(pts: DataFrame) -> DataFrame:
    """One row per cluster: n, mu (centroid), mnx (mean squared norm); written once."""
    c = (pts.select("cluster", F.posexplode("x").alias("j", "v")).groupBy("cluster", "j")
         .agg(F.avg("v").alias("c"), F.avg(F.col("v") * F.col("v")).alias("q"), F.count(F.lit(1)).alias("n")))
    g = c.groupBy("cluster").agg(F.max("n").alias("n"), F.sum("q").alias("mnx"),
                                 F.array_sort(F.collect_list(F.struct("j", "c"))).alias("m"))
    return materialize(g.select("cluster", "n", F.col("m.c").alias("mu"), "mnx"))


def _n_blocks(prof: DataFrame) -> int:
    """Broadcasts that the profiles need, from their counted coordinates."""
    entries = prof.agg(F.sum(F.size("mu"))).first()[0] or 0
    return max(1, -(-entries // PROFILE_ENTRIES))


def _with_own(pts: DataFrame, prof: DataFrame) -> DataFrame:
    """Points beside the profile of their own cluster."""
    if _n_blocks(prof) == 1:
        return pts.join(F.broadcast(prof), "cluster")
    spread = prof.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return pts.withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).join(spread, ["cluster", "_salt"]).drop("_salt")


def _with_extreme(rows: DataFrame, prof: DataFrame, name: str, value: Callable[[Column], Column], largest: bool) -> DataFrame:
    """``rows`` with the least or largest ``value`` (of a profile) over the clusters other than the row's own."""
    of_array, of_two = (F.array_max, F.greatest) if largest else (F.array_min, F.least)
    blocks = _n_blocks(prof)
    out = rows.withColumn(name, F.lit(None).cast("double"))
    for i in range(blocks):
        part = prof.where(F.pmod(F.xxhash64("cluster"), F.lit(blocks)) == i)
        part = part.agg(F.collect_list(F.struct(*prof.columns)).alias("_cs"))
        others = F.filter("_cs", lambda c: c["cluster"] != F.col("cluster"))
        out = (out.crossJoin(F.broadcast(part))
               .withColumn(name, of_two(F.col(name), of_array(F.transform(others, value)))).drop("_cs"))
        if blocks > 1:
            out = materialize(out)  # the next block's broadcast takes this one's place
    return out


def wcss(pts: DataFrame, prof: DataFrame | None = None) -> DataFrame:
    """Per cluster: size and within-cluster sum of squared distances."""
    d = _with_own(pts, profiles(pts) if prof is None else prof)
    return d.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"),
                                    F.sum(_sq_distance(F.col("x"), F.col("mu"))).alias("wcss"))


def _silhouette(a: Column, b: Column, n_own: Column) -> Column:
    return (F.when((n_own <= 1) | b.isNull(), F.lit(0.0))
            .otherwise(F.coalesce(F.try_divide(b - a, F.greatest(a, b)), F.lit(0.0))))


def silhouette_sq(pts: DataFrame, prof: DataFrame | None = None) -> DataFrame:
    """Per point silhouette with *squared* Euclidean distance, exactly,
    in O(n k d):  mean_j in C |x_i - x_j|^2 = |x_i|^2 - 2 x_i . mu_C + mean_j in C |x_j|^2.
    a(i) uses the own cluster without the point itself (n_A / (n_A - 1));
    a point alone in its cluster scores 0, as does one at distance 0 from all.
    Returns (id, cluster, s)."""
    prof = profiles(pts) if prof is None else prof
    nx = _dot(F.col("x"), F.col("x"))
    mean_d = lambda mu, mnx: nx - 2 * _dot(F.col("x"), mu) + mnx
    own = _with_own(pts, prof).select(
        "id", "cluster", "x", F.col("n").alias("n_own"),
        F.try_divide(mean_d(F.col("mu"), F.col("mnx")) * F.col("n"), (F.col("n") - 1).cast("double")).alias("a"))
    d = _with_extreme(own, prof, "b", lambda c: mean_d(c["mu"], c["mnx"]), largest=False)
    return d.select("id", "cluster", _silhouette(F.col("a"), F.col("b"), F.col("n_own")).alias("s"))


def silhouette_score_sq(pts: DataFrame, prof: DataFrame | None = None) -> DataFrame:
    """Mean of :func:`silhouette_sq` (the ``ClusteringEvaluator`` definition)."""
    return silhouette_sq(pts, prof).agg(F.avg("s").alias("silhouette_sq"), F.count(F.lit(1)).alias("n"))


def _distances(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Euclidean distances of two row sets; small ones from differences, as the product form cancels there."""
    nq, np_ = (q * q).sum(1), (p * p).sum(1)
    scale = nq[:, None] + np_[None, :]
    sq = scale - 2.0 * (q @ p.T)
    i, j = np.nonzero(sq <= 1e-5 * scale)
    for at in range(0, len(i), 100_000):
        u, v = i[at:at + 100_000], j[at:at + 100_000]
        sq[u, v] = ((q[u] - p[v]) ** 2).sum(1)
    return np.sqrt(np.maximum(sq, 0.0))


def _cell_sums(chosen: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
    """Sums of distances by (chosen row, cluster) of one grid cell."""
    if chosen.empty or points.empty:
        return pd.DataFrame({"id": [], "other": [], "total": []})
    q = np.stack(chosen["x"].to_numpy())
    parts = []
    for cluster, members in points.groupby("cluster"):
        total = np.zeros(len(q))
        x, times = np.stack(members["x"].to_numpy()), members["times"].to_numpy(dtype=float)
        for at in range(0, len(x), 2_000):
            total += _distances(q, x[at:at + 2_000]) @ times[at:at + 2_000]
        parts.append(pd.DataFrame({"id": chosen["id"].to_numpy(), "other": cluster, "total": total}))
    return pd.concat(parts)


def silhouette_euclidean(pts: DataFrame, chosen: Column | None = None, chosen_rows: int = CHOSEN_ROWS,
                         point_rows: int = POINT_ROWS) -> DataFrame:
    """K04, plain Euclidean distance: exact silhouette of the ``chosen`` rows
    (default: id divisible by 50) against all rows.  Returns (id, cluster, s).

    Equal points of a cluster are one with a multiplicity.  Blocks of chosen
    rows meet blocks of points in the cells of a grid, each of bounded size; a
    cell gives sums by (chosen row, cluster), so no pair is ever a row."""
    pts = materialize(pts)
    points = materialize(pts.groupBy("cluster", "x").agg(F.count(F.lit(1)).alias("times")))
    mine = pts.where(F.pmod("id", F.lit(50)) == 0 if chosen is None else chosen)
    n_q, n_p = -(-mine.count() // chosen_rows) or 1, -(-points.count() // point_rows) or 1
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = mine.withColumn("qb", F.pmod(F.xxhash64("id"), F.lit(n_q)).cast("int")).withColumn("pb", every(n_p))
    p = points.withColumn("pb", F.pmod(F.xxhash64("cluster", "x"), F.lit(n_p)).cast("int")).withColumn("qb", every(n_q))
    kinds = dict(pts.dtypes)
    sums = (q.groupBy("qb", "pb").cogroup(p.groupBy("qb", "pb"))
            .applyInPandas(_cell_sums, f"id {kinds['id']}, other {kinds['cluster']}, total double")
            .groupBy("id", "other").agg(F.sum("total").alias("total")))
    sizes = pts.groupBy(F.col("cluster").alias("other")).agg(F.count(F.lit(1)).alias("n"))
    own = F.col("other") == F.col("cluster")
    per = (sums.join(sizes, "other").join(mine.select("id", "cluster"), "id").groupBy("id", "cluster")
           .agg(F.max(F.when(own, F.try_divide(F.col("total"), (F.col("n") - 1).cast("double")))).alias("a"),
                F.max(F.when(own, F.col("n"))).alias("n_own"),
                F.min(F.when(~own, F.col("total") / F.col("n"))).alias("b")))
    return per.select("id", "cluster", _silhouette(F.col("a"), F.col("b"), F.col("n_own")).alias("s"))


def silhouette_score_euclidean(pts: DataFrame, chosen: Column | None = None) -> DataFrame:
    """Mean of :func:`silhouette_euclidean` over the chosen rows."""
    return silhouette_euclidean(pts, chosen).agg(F.avg("s").alias("silhouette"), F.count(F.lit(1)).alias("n"))


def davies_bouldin(pts: DataFrame, prof: DataFrame | None = None) -> DataFrame:
    """Mean over clusters of max_j (S_i + S_j) / |mu_i - mu_j|, S = mean
    Euclidean distance of members to their centroid."""
    prof = profiles(pts) if prof is None else prof
    s = (_with_own(pts, prof).groupBy("cluster")
         .agg(F.avg(F.sqrt(_sq_distance(F.col("x"), F.col("mu")))).alias("S")))
    spread = materialize(prof.join(s, "cluster").select("cluster", "mu", "S"))
    ratio = lambda c: F.try_divide(F.col("S") + c["S"], F.sqrt(_sq_distance(F.col("mu"), c["mu"])))
    return _with_extreme(spread, spread, "R", ratio, largest=True).agg(F.avg("R").alias("davies_bouldin"))


def calinski_harabasz(pts: DataFrame, prof: DataFrame | None = None) -> DataFrame:
    """(B / (k - 1)) / (W / (n - k))."""
    prof = profiles(pts) if prof is None else prof
    c = prof.select("cluster", "n", F.posexplode("mu").alias("j", "c"))  # k x d rows
    g = c.groupBy("j").agg((F.sum(F.col("c") * F.col("n")) / F.sum("n")).alias("g"))
    between = c.join(g, "j").agg(F.sum((F.col("c") - F.col("g")) ** 2 * F.col("n")).alias("B"))
    w = wcss(pts, prof).agg(F.sum("wcss").alias("W"), F.sum("size").alias("n"), F.count(F.lit(1)).alias("k"))
    return between.crossJoin(w).select(
        F.try_divide(F.try_divide(F.col("B"), (F.col("k") - 1).cast("double")),
                     F.try_divide(F.col("W"), (F.col("n") - F.col("k")).cast("double"))).alias("calinski_harabasz"))


def adjusted_rand(df: DataFrame, a: str, b: str) -> DataFrame:
    """ARI of two labelings from the contingency table (pair counts)."""
    pair = lambda c: c * (c - 1) / 2.0
    ct = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("nij"))
    sa = ct.groupBy(a).agg(F.sum("nij").alias("ai")).agg(F.sum(pair(F.col("ai"))).alias("sa"))
    sb = ct.groupBy(b).agg(F.sum("nij").alias("bj")).agg(F.sum(pair(F.col("bj"))).alias("sb"))
    si = ct.agg(F.sum(pair(F.col("nij"))).alias("sij"), F.sum("nij").alias("n"))
    j = si.crossJoin(sa).crossJoin(sb)
    expected = F.col("sa") * F.col("sb") / pair(F.col("n"))
    mx = (F.col("sa") + F.col("sb")) / 2
    return j.select(F.when(mx == expected, F.lit(1.0))
                    .otherwise((F.col("sij") - expected) / (mx - expected)).alias("ari"))


def cluster_sizes(df: DataFrame, cluster_col: str = "cluster", micro_pct: float = 5.0) -> DataFrame:
    """Size and share per cluster; flag clusters below ``micro_pct`` %."""
    g = df.groupBy(cluster_col).agg(F.count(F.lit(1)).alias("size"))
    tot = g.agg(F.sum("size").alias("_t"))
    return (g.crossJoin(F.broadcast(tot))
            .select(F.col(cluster_col).alias("cluster"), "size", (F.col("size") * 100.0 / F.col("_t")).alias("pct"))
            .withColumn("micro", F.col("pct") < micro_pct))
