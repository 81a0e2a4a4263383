"""K03-K07, K10, K18 (SQL oracles) and the MLlib clustering work (K01, K02, K08, K09,
K11-K15, K17, K19; rows-only checks)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import r6
from ..operators import rfm as R
from ..operators import validity as K
from ..session import in_parallel, materialize
from . import sqltext as S
from .registry import query
from .segment_queries import RULE_CLUSTERS, rfm_table

EMB_LONG = """
p AS (SELECT vec_id AS id, label AS cluster, unnest(generate_series(0, len(embedding) - 1)) AS j,
             unnest(CAST(embedding AS DOUBLE[])) AS v FROM embeddings),
c AS (SELECT cluster, j, avg(v) AS c, count(*) AS n FROM p GROUP BY cluster, j)"""


def emb_points(t):
    return K.vector_points(t.embeddings, "vec_id", "embedding", "label")


@query("k03_wcss", f"""
WITH {EMB_LONG},
pp AS (SELECT p.cluster, p.id, sum(power(p.v - c.c, 2)) AS sq FROM p JOIN c USING (cluster, j) GROUP BY 1, 2)
SELECT cluster, count(*) AS size, {S.r6('sum(sq)')} AS wcss FROM pp GROUP BY cluster""")
def k03_wcss(t):
    """Within-cluster sum of squares per cluster of the embedding labels."""
    return K.wcss(emb_points(t)).select("cluster", "size", r6("wcss").alias("wcss"))


_SIL_BRUTE = """
d AS (SELECT a.id, a.cluster AS own, b.cluster AS other, avg(power(list_distance(a.x, b.x), 2)) AS md
      FROM e a JOIN e b ON a.id <> b.id GROUP BY 1, 2, 3),
per AS (SELECT id, own, max(CASE WHEN other = own THEN md END) AS a,
               min(CASE WHEN other <> own THEN md END) AS b FROM d GROUP BY 1, 2)
SELECT """ + S.r6("avg(CASE WHEN a IS NULL OR b IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END)") + \
    """ AS silhouette_sq, count(*) AS n FROM per"""


@query("k04_silhouette_sq", """
WITH e AS (SELECT vec_id AS id, label AS cluster, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),""" + _SIL_BRUTE)
def k04_silhouette_sq(t):
    """Silhouette (squared Euclidean) of the embedding labels, O(n k d) closed form."""
    return K.silhouette_score_sq(emb_points(t)).select(r6("silhouette_sq").alias("silhouette_sq"), "n")


@query("k04_silhouette_sq_rfm", f"""
WITH {RULE_CLUSTERS},
lg AS (SELECT customer_id, cluster, ln(1 + CAST(recency AS DOUBLE)) AS r, ln(1 + CAST(frequency AS DOUBLE)) AS f,
              ln(1 + monetary) AS m FROM cl),
e AS (SELECT customer_id AS id, cluster,
             [(r - avg(r) OVER ()) / stddev_pop(r) OVER (), (f - avg(f) OVER ()) / stddev_pop(f) OVER (),
              (m - avg(m) OVER ()) / stddev_pop(m) OVER ()] AS x FROM lg),""" + _SIL_BRUTE)
def k04_silhouette_sq_rfm(t):
    """Silhouette (squared Euclidean) of the rule clusters on scaled RFM."""
    from .segment_queries import _rule_profile
    cl = _rule_profile(t)[1]
    z = R.rfm_scaled(cl)
    pts = K.column_points(z, "customer_id", [f"{c}_z" for c in R.RFM])
    return K.silhouette_score_sq(pts).select(r6("silhouette_sq").alias("silhouette_sq"), "n")


# the stated rows (id divisible by 50) against all rows, plain distances
_SIL_EUCLIDEAN = """
d AS (SELECT a.id, a.cluster AS own, b.cluster AS other, avg(list_distance(a.x, b.x)) AS md
      FROM e a JOIN e b ON a.id <> b.id WHERE a.id % 50 = 0 GROUP BY 1, 2, 3),
per AS (SELECT id, max(CASE WHEN other = own THEN md END) AS a, min(CASE WHEN other <> own THEN md END) AS b
        FROM d GROUP BY id)
SELECT """ + S.r6("avg(CASE WHEN a IS NULL OR b IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END)") + \
    """ AS silhouette, count(*) AS n FROM per"""


@query("k04_silhouette_euclidean", """
WITH e AS (SELECT vec_id AS id, label AS cluster, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),""" + _SIL_EUCLIDEAN)
def k04_silhouette_euclidean(t):
    """Silhouette (plain Euclidean) of the embedding labels: vectors with an id divisible by 50 against all."""
    return K.silhouette_score_euclidean(emb_points(t)).select(r6("silhouette").alias("silhouette"), "n")


@query("k04_silhouette_euclidean_rfm", f"""
WITH {RULE_CLUSTERS},
lg AS (SELECT customer_id, cluster, ln(1 + CAST(recency AS DOUBLE)) AS r, ln(1 + CAST(frequency AS DOUBLE)) AS f,
              ln(1 + monetary) AS m FROM cl),
e AS (SELECT customer_id AS id, cluster,
             [(r - avg(r) OVER ()) / stddev_pop(r) OVER (), (f - avg(f) OVER ()) / stddev_pop(f) OVER (),
              (m - avg(m) OVER ()) / stddev_pop(m) OVER ()] AS x FROM lg),""" + _SIL_EUCLIDEAN)
def k04_silhouette_euclidean_rfm(t):
    """Silhouette (plain Euclidean) of the rule clusters on scaled RFM: customers with an id divisible by 50 against all."""
    from .segment_queries import _rule_profile
    z = R.rfm_scaled(_rule_profile(t)[1])
    pts = K.column_points(z, "customer_id", [f"{c}_z" for c in R.RFM])
    return K.silhouette_score_euclidean(pts).select(r6("silhouette").alias("silhouette"), "n")


@query("k05_davies_bouldin", f"""
WITH {EMB_LONG},
dist AS (SELECT p.cluster, p.id, sqrt(sum(power(p.v - c.c, 2))) AS d FROM p JOIN c USING (cluster, j) GROUP BY 1, 2),
s AS (SELECT cluster, avg(d) AS S FROM dist GROUP BY 1),
m AS (SELECT a.cluster AS ci, b.cluster AS cj, sqrt(sum(power(a.c - b.c, 2))) AS M
      FROM c a JOIN c b ON a.j = b.j AND a.cluster <> b.cluster GROUP BY 1, 2),
r AS (SELECT ci, max((si.S + sj.S) / M) AS R FROM m JOIN s si ON si.cluster = ci JOIN s sj ON sj.cluster = cj GROUP BY ci)
SELECT {S.r6('avg(R)')} AS davies_bouldin FROM r""")
def k05_davies_bouldin(t):
    return K.davies_bouldin(emb_points(t)).select(r6("davies_bouldin").alias("davies_bouldin"))


@query("k06_calinski_harabasz", f"""
WITH {EMB_LONG},
g AS (SELECT j, avg(v) AS g FROM p GROUP BY j),
b AS (SELECT c.cluster, sum(power(c.c - g.g, 2)) * any_value(c.n) AS bs FROM c JOIN g USING (j) GROUP BY c.cluster),
w AS (SELECT sum(power(p.v - c.c, 2)) AS W, count(DISTINCT p.id) AS n FROM p JOIN c USING (cluster, j))
SELECT {S.r6('(sum(bs) / (count(*) - 1)) / (any_value(W) / (any_value(n) - count(*)))')} AS calinski_harabasz
FROM b CROSS JOIN w""")
def k06_calinski_harabasz(t):
    return K.calinski_harabasz(emb_points(t)).select(r6("calinski_harabasz").alias("calinski_harabasz"))


@query("k07_adjusted_rand", f"""
WITH x AS (SELECT label AS a, list_position(embedding, list_max(embedding)) AS b FROM embeddings),
ct AS (SELECT a, b, count(*) AS nij FROM x GROUP BY 1, 2),
sa AS (SELECT sum(ai * (ai - 1) / 2.0) AS sa FROM (SELECT sum(nij) AS ai FROM ct GROUP BY a)),
sb AS (SELECT sum(bj * (bj - 1) / 2.0) AS sb FROM (SELECT sum(nij) AS bj FROM ct GROUP BY b)),
si AS (SELECT sum(nij * (nij - 1) / 2.0) AS sij, sum(nij) AS n FROM ct)
SELECT {S.r6('(sij - sa * sb / (n * (n - 1) / 2.0)) / ((sa + sb) / 2 - sa * sb / (n * (n - 1) / 2.0))')} AS ari
FROM si, sa, sb""")
def k07_adjusted_rand(t):
    """ARI between the embedding labels and the place of each vector's largest coordinate."""
    e = t.embeddings.select("label", F.array_position("embedding", F.array_max("embedding")).alias("b"))
    return K.adjusted_rand(e, "label", "b").select(r6("ari").alias("ari"))


@query("k18_cluster_sizes", f"""
WITH {RULE_CLUSTERS}
SELECT cluster, count(*) AS size, {S.r6('count(*) * 100.0 / (SELECT count(*) FROM cl)')} AS pct,
       count(*) * 100.0 / (SELECT count(*) FROM cl) < 5.0 AS micro
FROM cl GROUP BY cluster""")
def k18_cluster_sizes(t):
    """Cluster sizes / shares with a micro-cluster flag (< 5 %)."""
    from .segment_queries import _rule_profile
    s = K.cluster_sizes(_rule_profile(t)[1])
    return s.select("cluster", "size", r6("pct").alias("pct"), "micro")


# --- MLlib fits (rows-only checks) -------------------------------------------

from ..operators import cluster as CL  # noqa: E402
from ..operators import scaling as SC  # noqa: E402

Z_COLS = [f"{c}_z" for c in R.RFM]


def _standardise(df, cols, suffix):
    mom = df.agg(*[F.avg(c).alias(f"_{c}_mu") for c in cols], *[F.stddev_pop(c).alias(f"_{c}_sd") for c in cols])
    out = df.crossJoin(F.broadcast(mom))
    for c in cols:
        out = out.withColumn(c + suffix, (F.col(c) - F.col(f"_{c}_mu")) / F.col(f"_{c}_sd"))
    return out.drop(*[f"_{c}_{s}" for c in cols for s in ("mu", "sd")])


def rfm_vectors(t, cols=Z_COLS):
    """log1p + population z-score of R, F, M as an MLlib vector, materialised for the fits."""
    z = R.rfm_scaled(rfm_table(t))
    return materialize(CL.assemble(z, cols).select("customer_id", "features", *R.RFM))


def _spark(t):
    return t.spark


@query("k01_k_sweep")
def k01_k_sweep(t):
    """k = 2..10: WCSS of the best of 10 restarts and its silhouette."""
    v = rfm_vectors(t)
    return CL.k_sweep(_spark(t), v, range(2, 11), n_init=10)


@query("k02_final_kmeans")
def k02_final_kmeans(t):
    """Final k = 4 fit (best of 10 restarts): cluster of every customer."""
    v = rfm_vectors(t)
    m = CL.fit_kmeans(v, 4, n_init=10)
    return m.transform(v).select("customer_id", "cluster", *R.RFM)


@query("k08_bootstrap_stability")
def k08_bootstrap_stability(t):
    """20 Poisson-bootstrap refits; ARI against the base solution on the drawn customers."""
    v = rfm_vectors(t)
    base = CL.fit_kmeans(v, 4, n_init=10)
    return CL.bootstrap_stability(_spark(t), v, base, 4, "customer_id", b_reps=20, n_init=10)


@query("k08_bootstrap_summary")
def k08_bootstrap_summary(t):
    """Mean, population sd and minimum of the bootstrap ARI."""
    return CL.stability_summary(k08_bootstrap_stability(t.spark, t.root))


@query("k09_seed_summary")
def k09_seed_summary(t):
    """Mean, population sd and minimum of the ARI over seeds."""
    return CL.stability_summary(k09_seed_stability(t.spark, t.root))


@query("k09_seed_stability")
def k09_seed_stability(t):
    """Refits under 5 other seeds; ARI against the base solution."""
    v = rfm_vectors(t)
    base = CL.fit_kmeans(v, 4, n_init=10)
    return CL.seed_stability(_spark(t), v, base, 4)


@query("k11_minmax", f"""
WITH {S.RFM},
lg AS (SELECT customer_id, ln(1 + CAST(recency AS DOUBLE)) AS r, ln(1 + CAST(frequency AS DOUBLE)) AS f,
              ln(1 + monetary) AS m FROM rfm)
SELECT customer_id, {S.r6('(r - min(r) OVER ()) / (max(r) OVER () - min(r) OVER ())')} AS recency_mm,
       {S.r6('(f - min(f) OVER ()) / (max(f) OVER () - min(f) OVER ())')} AS frequency_mm,
       {S.r6('(m - min(m) OVER ()) / (max(m) OVER () - min(m) OVER ())')} AS monetary_mm FROM lg""")
def k11_minmax(t):
    """log1p + min-max scaling of R, F, M."""
    lg = rfm_table(t).select("customer_id", *[F.log1p(F.col(c).cast("double")).alias(c) for c in R.RFM])
    return SC.minmax(lg, R.RFM).select("customer_id", *[r6(f"{c}_mm").alias(f"{c}_mm") for c in R.RFM])


@query("k11_robust", f"""
WITH {S.RFM},
lg AS (SELECT customer_id, ln(1 + CAST(recency AS DOUBLE)) AS r, ln(1 + CAST(frequency AS DOUBLE)) AS f,
              ln(1 + monetary) AS m FROM rfm),
q AS (SELECT quantile_cont(r, 0.25) r1, quantile_cont(r, 0.5) r2, quantile_cont(r, 0.75) r3,
             quantile_cont(f, 0.25) f1, quantile_cont(f, 0.5) f2, quantile_cont(f, 0.75) f3,
             quantile_cont(m, 0.25) m1, quantile_cont(m, 0.5) m2, quantile_cont(m, 0.75) m3 FROM lg)
SELECT customer_id, {S.r6('(r - r2) / CASE WHEN r3 = r1 THEN 1 ELSE r3 - r1 END')} AS recency_rb,
       {S.r6('(f - f2) / CASE WHEN f3 = f1 THEN 1 ELSE f3 - f1 END')} AS frequency_rb,
       {S.r6('(m - m2) / CASE WHEN m3 = m1 THEN 1 ELSE m3 - m1 END')} AS monetary_rb FROM lg CROSS JOIN q""")
def k11_robust(t):
    """log1p + robust scaling (median / IQR) of R, F, M."""
    lg = rfm_table(t).select("customer_id", *[F.log1p(F.col(c).cast("double")).alias(c) for c in R.RFM])
    return SC.robust(lg, R.RFM).select("customer_id", *[r6(f"{c}_rb").alias(f"{c}_rb") for c in R.RFM])


@query("k11_yeo_johnson")
def k11_yeo_johnson(t):
    """Yeo-Johnson (MLE lambda per feature) + z-score of raw R, F, M."""
    yj = SC.yeo_johnson(rfm_table(t), R.RFM)
    return yj.select("customer_id", *[f"{c}_yj" for c in R.RFM], *[f"{c}_lambda" for c in R.RFM])


@query("k11_quantile_normal")
def k11_quantile_normal(t):
    """Quantile -> normal map (1000 reference quantiles) of raw R, F, M."""
    qn = SC.quantile_normal(rfm_table(t), R.RFM)
    return qn.select("customer_id", *[f"{c}_qn" for c in R.RFM])


def _tables(frames):
    """One row per customer with an array column for each frame of (customer_id, columns)."""
    parts = [df.select("customer_id", F.array(*cols).alias(name)) for name, df, cols in frames]
    return materialize(reduce(lambda a, b: a.join(b, "customer_id"), parts))


@query("k12_transform_sweep")
def k12_transform_sweep(t):
    """Silhouette per feature transform x k (2..7), best of 10 restarts each, and the best k of the transform."""
    r = materialize(rfm_table(t).select("customer_id", *[F.col(c).cast("double").alias(c) for c in R.RFM]))
    lg = r.select("customer_id", *[F.log1p(F.col(c)).alias(c) for c in R.RFM])
    cols = [f"{c}_t" for c in R.RFM]
    x = _tables([("raw_standard", _standardise(r, R.RFM, "_t"), cols), ("log1p_standard", _standardise(lg, R.RFM, "_t"), cols),
                 ("log1p_minmax", SC.minmax(lg, R.RFM, "_t"), cols), ("log1p_robust", SC.robust(lg, R.RFM, "_t"), cols),
                 ("yeo_johnson", SC.yeo_johnson(r, R.RFM, "_t"), cols),
                 ("quantile_normal", SC.quantile_normal(r, R.RFM, suffix="_t"), cols)])
    rows = CL.sweep(x, [c for c in x.columns if c != "customer_id"], range(2, 8))
    df = t.spark.createDataFrame(rows, "transform string, k int, wcss double, silhouette_sq double")
    best = df.groupBy("transform").agg(F.max_by("k", F.struct("silhouette_sq", -F.col("k"))).alias("best_k"))
    return df.join(best, "transform")


@query("k13_feature_subsets")
def k13_feature_subsets(t):
    """Silhouette of log1p+z feature subsets (RFM, RM, RF, FM) for k = 3, 4, 5."""
    z = materialize(_standardise(rfm_table(t).select("customer_id", *[F.log1p(F.col(c).cast("double")).alias(c) for c in R.RFM]),
                                 R.RFM, "_z"))
    subsets = {"RFM": R.RFM, "RM": ["recency", "monetary"], "RF": ["recency", "frequency"], "FM": ["frequency", "monetary"]}
    x = z.select(*[F.array(*[f"{c}_z" for c in cols]).alias(n) for n, cols in subsets.items()])
    rows = [(n, k, s) for n, k, _, s in CL.sweep(materialize(x), list(subsets), (3, 4, 5))]
    return t.spark.createDataFrame(rows, "subset string, k int, silhouette_sq double")


def _compare(t, algorithms):
    v = rfm_vectors(t)
    return CL.algorithm_comparison(_spark(t), v, "customer_id", (3, 4, 5), algorithms=algorithms)


@query("k14_gaussian_mixture")
def k14_gaussian_mixture(t):
    """Gaussian mixture, k = 3, 4, 5: silhouette, Davies-Bouldin, Calinski-Harabasz."""
    return _compare(t, ["gaussian_mixture"])


@query("k15_bisecting_kmeans")
def k15_bisecting_kmeans(t):
    """Divisive (bisecting k-means) stand-in for Ward linkage, k = 3, 4, 5."""
    return _compare(t, ["bisecting_kmeans"])


@query("k17_pca")
def k17_pca(t):
    """PCA to 2 / 3 components: explained variance and k = 4 silhouette there."""
    v = rfm_vectors(t)
    return CL.pca_projection(_spark(t), v)


@query("k19_algorithm_comparison")
def k19_algorithm_comparison(t):
    """k-means, Gaussian mixture and bisecting k-means for k = 3, 4, 5, and DBSCAN for each eps (indices without
    noise): three indices."""
    z = materialize(R.rfm_scaled(rfm_table(t)).select("customer_id", *Z_COLS))
    rows = CL.dbscan_rows(t.spark, z, "customer_id", Z_COLS, EPS_LIST, 10)
    return _compare(t, ["kmeans", "gaussian_mixture", "bisecting_kmeans"]).unionByName(rows, allowMissingColumns=True)


# --- K16: DBSCAN ---------------------------------------------------------------

from ..operators import density as DN  # noqa: E402

EPS_LIST = [0.3, 0.5, 0.7, 1.0]


def _dbscan_sql() -> str:
    parts = []
    for eps in EPS_LIST:
        parts.append(f"""
SELECT CAST({eps} AS DOUBLE) AS eps, count(*) FILTER (WHERE core) AS core,
       count(*) FILTER (WHERE NOT core AND near_core) AS border,
       count(*) FILTER (WHERE NOT core AND NOT near_core) AS noise
FROM (SELECT a.id, any_value(a.core) AS core, bool_or(b.core AND a.id <> b.id) AS near_core
      FROM (SELECT id, n{int(eps * 10)} >= 10 AS core FROM cnt) a
      JOIN pr ON pr.id = a.id AND pr.d2 <= {eps} * {eps}
      JOIN (SELECT id, n{int(eps * 10)} >= 10 AS core FROM cnt) b ON b.id = pr.nid
      GROUP BY a.id)""")
    counts = ", ".join(f"count(*) FILTER (WHERE d2 <= {eps} * {eps}) AS n{int(eps * 10)}" for eps in EPS_LIST)
    return f"""
WITH {S.RFM},
lg AS (SELECT customer_id, ln(1 + CAST(recency AS DOUBLE)) AS r, ln(1 + CAST(frequency AS DOUBLE)) AS f,
              ln(1 + monetary) AS m FROM rfm),
z AS (SELECT customer_id AS id, (r - avg(r) OVER ()) / stddev_pop(r) OVER () AS x0,
             (f - avg(f) OVER ()) / stddev_pop(f) OVER () AS x1, (m - avg(m) OVER ()) / stddev_pop(m) OVER () AS x2
      FROM lg),
pr AS (SELECT a.id, b.id AS nid, (a.x0 - b.x0) * (a.x0 - b.x0) + (a.x1 - b.x1) * (a.x1 - b.x1)
              + (a.x2 - b.x2) * (a.x2 - b.x2) AS d2 FROM z a, z b),
cnt AS (SELECT id, {counts} FROM pr GROUP BY id)""" + "\nUNION ALL".join(parts)


@query("k16_dbscan_density", _dbscan_sql())
def k16_dbscan_density(t):
    """DBSCAN density labels (min_samples 10, eps 0.3 / 0.5 / 0.7 / 1.0) on log1p + z RFM:
    core, border and noise counts."""
    z = materialize(R.rfm_scaled(rfm_table(t)).select("customer_id", *Z_COLS))  # read once per eps pass
    return DN.density_summary(z, "customer_id", Z_COLS, EPS_LIST, 10).drop("clusters")


@query("k16_dbscan_clusters")
def k16_dbscan_clusters(t):
    """Label and cluster of every customer at eps 0.5."""
    z = materialize(R.rfm_scaled(rfm_table(t)).select("customer_id", *Z_COLS))
    return DN.dbscan(z, "customer_id", Z_COLS, 0.5, 10).withColumnRenamed("id", "customer_id")


@query("k16_dbscan_summary")
def k16_dbscan_summary(t):
    """Per eps: clusters, points in them, noise, and the silhouette of the points without noise."""
    z = materialize(R.rfm_scaled(rfm_table(t)).select("customer_id", *Z_COLS))
    return CL.dbscan_rows(t.spark, z, "customer_id", Z_COLS, EPS_LIST, 10) \
        .select("eps", "clusters", "clustered", "noise", "silhouette_sq")


# --- K10: Hopkins statistic -------------------------------------------------------

from ..operators import nearest as NN  # noqa: E402

HOPKINS_SEEDS = range(5)


def _hopkins_sql(name: str, axes: list[str]) -> str:
    """All pairs: drawn points against the other points, and as many even places against all points."""
    d2 = " + ".join(f"power(q.x{i} - p.x{i}, 2)" for i in range(3))
    h = S.unit_hash
    draw = [h(f"customer_id, 'axis{i}', seed", "") for i in range(3)]
    even = ", ".join(f"lo{i} + {draw[i]} * (hi{i} - lo{i}) AS x{i}" for i in range(3))
    return f"""
z_{name} AS (SELECT customer_id, {", ".join(f"({a} - avg({a}) OVER ()) / stddev_pop({a}) OVER () AS x{i}" for i, a in enumerate(axes))} FROM lg),
b_{name} AS (SELECT {", ".join(f"min(x{i}) AS lo{i}, max(x{i}) AS hi{i}" for i in range(3))} FROM z_{name}),
q_{name} AS (SELECT z.*, seed FROM z_{name} z CROSS JOIN range(5) s(seed) WHERE {h("customer_id, concat('draw', seed)", "")} < 0.1),
e_{name} AS (SELECT customer_id, seed, {even} FROM q_{name} CROSS JOIN b_{name}),
w_{name} AS (SELECT seed, sum(d) AS w FROM (SELECT q.seed, q.customer_id, sqrt(min({d2})) AS d FROM q_{name} q
  JOIN z_{name} p ON p.customer_id <> q.customer_id GROUP BY 1, 2) GROUP BY seed),
u_{name} AS (SELECT seed, sum(d) AS u FROM (SELECT q.seed, q.customer_id, sqrt(min({d2})) AS d FROM e_{name} q
  CROSS JOIN z_{name} p GROUP BY 1, 2) GROUP BY seed),
h_{name} AS (SELECT '{name}' AS representation, CAST(5 AS BIGINT) AS seeds, {S.r6("avg(u / (u + w))")} AS hopkins FROM u_{name} JOIN w_{name} USING (seed))"""


@query("k10_hopkins", f"""
WITH {S.RFM},
lg AS (SELECT customer_id, CAST(recency AS DOUBLE) AS r, CAST(frequency AS DOUBLE) AS f, monetary AS m,
              ln(1 + CAST(recency AS DOUBLE)) AS lr, ln(1 + CAST(frequency AS DOUBLE)) AS lf, ln(1 + monetary) AS lm FROM rfm),
{_hopkins_sql("log", ["lr", "lf", "lm"])},
{_hopkins_sql("raw", ["r", "f", "m"])}
SELECT * FROM h_log UNION ALL SELECT * FROM h_raw""")
def k10_hopkins(t):
    """Clustering tendency of standardised RFM, as the model sees it (log) and as it is (raw): mean of five seeds."""
    rfm = materialize(rfm_table(t).select("customer_id", *[F.col(c).cast("double").alias(c) for c in R.RFM]))

    def one(name):
        x = rfm.select("customer_id", *[(F.log1p(c) if name == "log" else F.col(c)).alias(c) for c in R.RFM])
        m = x.agg(*[f(c).alias(f"{k}_{c}") for c in R.RFM for k, f in (("mean", F.avg), ("sd", F.stddev_pop))])
        z = x.crossJoin(F.broadcast(m)).select("customer_id", *[((F.col(c) - F.col(f"mean_{c}")) / F.col(f"sd_{c}")).alias(c) for c in R.RFM])
        return NN.hopkins(z, "customer_id", R.RFM, HOPKINS_SEEDS).select(F.lit(name).alias("representation"), "seeds", r6("hopkins").alias("hopkins"))
    return reduce(DataFrame.unionByName, in_parallel(t.spark, one, ["log", "raw"]))
