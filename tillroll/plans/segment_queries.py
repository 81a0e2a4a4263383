"""R01-R08 over the star-schema tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import r6
from ..operators import rfm as R
from ..session import materialize
from ..sources import retail
from . import sqltext as S
from .registry import query


def rfm_table(t):
    return R.rfm_from_invoices(retail.invoices(t), states=retail.customer_states(t))


@query("r01_snapshot", f"""
WITH {S.INVOICES}
SELECT strftime(max(inv_ts) + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS snapshot_ts FROM inv""")
def r01_snapshot(t):
    """Snapshot = latest invoice + 1 day."""
    return R.snapshot(retail.invoices(t), "inv_ts").select(
        F.date_format("snapshot_ts", "yyyy-MM-dd HH:mm:ss").alias("snapshot_ts"))


@query("r02_rfm", f"""
WITH {S.RFM}
SELECT customer_id, recency, frequency, monetary, state FROM rfm_s""")
def r02_rfm(t):
    """Recency / frequency / monetary (+ state) per customer."""
    return rfm_table(t)


def _summary_sql() -> str:
    parts = []
    for f in ["recency", "frequency", "monetary"]:
        parts.append(f"""
SELECT '{f}' AS feature, count(x) AS count, {S.r6('avg(x)')} AS mean, {S.r6('stddev_samp(x)')} AS std,
       {S.r6('min(x)')} AS min, {S.r6('max(x)')} AS max,
       {S.r6('avg(power(x - mx, 3)) / power(avg(power(x - mx, 2)), 1.5)')} AS skew_raw,
       {S.r6('avg(power(lx - mlx, 3)) / power(avg(power(lx - mlx, 2)), 1.5)')} AS skew_log1p,
       {S.r6('quantile_cont(x, 0.25)')} AS p25, {S.r6('quantile_cont(x, 0.5)')} AS p50,
       {S.r6('quantile_cont(x, 0.75)')} AS p75
FROM (SELECT CAST({f} AS DOUBLE) AS x, ln(1 + CAST({f} AS DOUBLE)) AS lx,
             avg(CAST({f} AS DOUBLE)) OVER () AS mx, avg(ln(1 + CAST({f} AS DOUBLE))) OVER () AS mlx
      FROM rfm)""")
    return f"WITH {S.RFM}" + "\nUNION ALL".join(parts)


@query("r03_rfm_summary", _summary_sql())
def r03_rfm_summary(t):
    """Describe + skewness of raw and log1p R, F, M."""
    s = R.rfm_summary(rfm_table(t))
    return s.select("feature", "count", *[r6(c).alias(c) for c in
                                         ["mean", "std", "min", "max", "skew_raw", "skew_log1p",
                                          "p25", "p50", "p75"]])


@query("r04_rfm_scaled", f"""
WITH {S.RFM},
lg AS (SELECT customer_id, ln(1 + CAST(recency AS DOUBLE)) AS r, ln(1 + CAST(frequency AS DOUBLE)) AS f,
              ln(1 + monetary) AS m FROM rfm)
SELECT customer_id,
       {S.r6('(r - avg(r) OVER ()) / stddev_pop(r) OVER ()')} AS recency_z,
       {S.r6('(f - avg(f) OVER ()) / stddev_pop(f) OVER ()')} AS frequency_z,
       {S.r6('(m - avg(m) OVER ()) / stddev_pop(m) OVER ()')} AS monetary_z
FROM lg""")
def r04_rfm_scaled(t):
    """log1p + population z-score of R, F, M."""
    z = R.rfm_scaled(rfm_table(t))
    return z.select("customer_id", *[r6(f"{c}_z").alias(f"{c}_z") for c in R.RFM])


RULE_TAIL = """
meds AS (SELECT quantile_cont(CAST(recency AS DOUBLE), 0.5) AS rm, quantile_cont(monetary, 0.5) AS mm FROM rfm),
cl AS (SELECT r.*, (CASE WHEN r.recency <= m.rm THEN 2 ELSE 0 END) + (CASE WHEN r.monetary >= m.mm THEN 1 ELSE 0 END)
              AS cluster FROM rfm_s r CROSS JOIN meds m),
prof AS (
  SELECT cluster, count(*) AS count, """ + S.r1("avg(CAST(recency AS DOUBLE))") + """ AS recency_mean,
         """ + S.r1("avg(CAST(frequency AS DOUBLE))") + """ AS frequency_mean,
         """ + S.r1("avg(monetary)") + """ AS monetary_mean,
         """ + S.r1("quantile_cont(monetary, 0.5)") + """ AS monetary_median,
         """ + S.r1("count(*) * 100.0 / (SELECT count(*) FROM cl)") + """ AS pct_of_customers
  FROM cl GROUP BY cluster),
popm AS (SELECT quantile_cont(CAST(recency AS DOUBLE), 0.5) AS pr, quantile_cont(CAST(frequency AS DOUBLE), 0.5) AS pf,
                quantile_cont(monetary, 0.5) AS pm FROM rfm),
seglab AS (
  SELECT p.*, CASE
    WHEN recency_mean <= pr AND frequency_mean >= pf AND monetary_mean >= pm THEN 'Champions (recent, frequent, high spend)'
    WHEN recency_mean <= pr AND monetary_mean >= pm THEN 'Big Spenders (recent, high value, infrequent)'
    WHEN recency_mean <= pr AND frequency_mean >= pf THEN 'Loyal Regulars (recent, frequent, modest spend)'
    WHEN recency_mean <= pr THEN 'New / Promising (recent, low frequency & value)'
    WHEN monetary_mean >= pm AND frequency_mean >= pf THEN 'At-Risk High Value (lapsing loyal spender)'
    WHEN monetary_mean >= pm THEN 'At-Risk Big Spender (lapsing, was high value)'
    WHEN frequency_mean >= pf THEN 'Lapsing Regulars (was frequent, modest value)'
    ELSE 'Lost / Dormant Low-Value' END AS base_label
  FROM prof p CROSS JOIN popm),
final AS (
  SELECT *, CASE WHEN count(*) OVER (PARTITION BY base_label) > 1
     THEN base_label || ' [rank ' || CAST(floor(rank() OVER (ORDER BY monetary_mean DESC)
          + (count(*) OVER (PARTITION BY monetary_mean) - 1) / 2.0) AS BIGINT) || ']'
     ELSE base_label END AS segment_label
  FROM seglab)"""
RULE_CLUSTERS = S.RFM + "," + RULE_TAIL


def _rule_profile(t):
    """(rfm, clustered, profile, medians); the customer table and its medians are
    reused by every pass below, so they are materialised once."""
    r = materialize(rfm_table(t))
    med = materialize(R.population_medians(r))
    cl = R.rule_clusters(r, med)
    return r, cl, R.segment_profile(cl), med


@query("r05_segment_profile", f"""
WITH {RULE_CLUSTERS}
SELECT cluster, count, recency_mean, frequency_mean, monetary_mean, monetary_median, pct_of_customers FROM prof""")
def r05_segment_profile(t):
    """Per-cluster profile over the rule-based 4-way clustering."""
    return _rule_profile(t)[2]


@query("r06_segment_rule_labels", f"""
WITH {RULE_CLUSTERS}
SELECT cluster, recency_mean, frequency_mean, monetary_mean, base_label AS segment_label FROM seglab""")
def r06_segment_rule_labels(t):
    """Cluster label from means vs population medians (3 flags, 8 names)."""
    r, _, prof, med = _rule_profile(t)
    return R.rule_labels(prof, r, med).select("cluster", "recency_mean", "frequency_mean", "monetary_mean",
                                         "segment_label")


@query("r07_label_disambiguation", f"""
WITH {RULE_CLUSTERS}
SELECT cluster, monetary_mean, segment_label FROM final""")
def r07_label_disambiguation(t):
    """Duplicate labels get ' [rank r]' by mean monetary."""
    r, _, prof, med = _rule_profile(t)
    return R.label_segments(prof, r, med).select("cluster", "monetary_mean", "segment_label")


@query("r08_customer_segments", f"""
WITH {RULE_CLUSTERS}
SELECT c.customer_id, c.recency, c.frequency, c.monetary, c.state, c.cluster, f.segment_label
FROM cl c LEFT JOIN final f USING (cluster)""")
def r08_customer_segments(t):
    """Every customer with its cluster and segment label."""
    r, cl, prof, med = _rule_profile(t)
    return R.assign_labels(cl, R.label_segments(prof, r, med)).select(
        "customer_id", "recency", "frequency", "monetary", "state", "cluster", "segment_label")
