"""P01-P16 (features) and P20-P28, P32, P37 (evaluation on fixed predictions)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.hashing import unit_hash
from ..functions.numeric import r6
from ..functions.quantiles import quantiles
from ..operators import evaluate as E
from ..operators import features as P
from ..session import materialize
from ..sources import retail
from . import sqltext as S
from .registry import query

CUTOFF = "2000-01-01"
C = "TIMESTAMP '2000-01-01'"

FEATURES = S.INVOICES + f""",
base AS (
  SELECT customer_id,
         date_sub('day', max(inv_ts) FILTER (WHERE inv_ts < {C}), {C}) AS recency,
         count(*) FILTER (WHERE inv_ts < {C}) AS frequency,
         CAST(sum(inv_cents) FILTER (WHERE inv_ts < {C}) AS DOUBLE) / 100 AS monetary,
         date_sub('day', min(inv_ts) FILTER (WHERE inv_ts < {C}), {C}) AS tenure,
         coalesce(CAST(sum(inv_cents) FILTER (WHERE inv_ts >= {C}) AS DOUBLE) / 100, 0.0) AS future_spend
  FROM inv GROUP BY customer_id HAVING count(*) FILTER (WHERE inv_ts < {C}) > 0),
feat AS (SELECT *, monetary / frequency AS avg_order_value FROM base),
st AS (SELECT *, CAST(future_spend > (SELECT quantile_cont(future_spend, 0.5) FROM feat) AS INTEGER) AS half,
              {S.unit_hash('customer_id', 'split42')} AS u FROM feat),
rk AS (SELECT *, row_number() OVER (PARTITION BY half ORDER BY u) AS nth, count(*) OVER (PARTITION BY half) AS of_n FROM st),
sp AS (SELECT * EXCLUDE (half, u, nth, of_n), CASE WHEN nth <= ceil(of_n / 5.0) THEN 'test' ELSE 'train' END AS split
       FROM rk),
thr AS (SELECT quantile_cont(future_spend, 0.5) AS threshold FROM sp WHERE split = 'train'),
lab AS (SELECT sp.*, thr.threshold, CAST(future_spend > threshold AS INTEGER) AS label FROM sp CROSS JOIN thr),
fp AS (
  SELECT *, floor((0.5 * {S.unit_hash('customer_id', 'sa')} + 0.5 * label * {S.unit_hash('customer_id', 'sb')}) * 100)
              / 100 AS score_a,
         floor((0.6 * {S.unit_hash('customer_id', 'sc')} + 0.4 * label) * 100) / 100 AS score_b,
         CAST(floor({S.unit_hash('customer_id', 'fold')} * 5) AS INTEGER) AS fold
  FROM lab),
preds AS (
  SELECT customer_id, split, fold, label, future_spend, threshold, 'model_a' AS model, score_a AS score,
         CAST(score_a >= 0.5 AS INTEGER) AS prediction FROM fp
  UNION ALL
  SELECT customer_id, split, fold, label, future_spend, threshold, 'model_b', score_b,
         CAST(score_b >= 0.5 AS INTEGER) FROM fp)"""


def inv(t):
    return retail.invoices(t)


def features(t):
    """Customer feature table, materialised once: labels, splits, thresholds and
    every evaluation pass read it instead of re-aggregating the line table."""
    return materialize(P.base_features(inv(t), CUTOFF))


def labelled(t):
    """Features with split and label, materialised: the split's quantiles are computed once for all that reads it."""
    return materialize(P.label_by_train_median(materialize(P.stratified_split(features(t)))))


def fixed_predictions(t):
    """Deterministic scores from key hashes (informative, with ties) for two
    'models', so every evaluation operator has an exact SQL oracle."""
    l_ = labelled(t)

    def u(tag):
        return unit_hash(F.col("customer_id"), seed=tag)
    fp = (l_.withColumn("score_a", F.floor((0.5 * u("sa") + 0.5 * F.col("label") * u("sb")) * 100) / 100)
          .withColumn("score_b", F.floor((0.6 * u("sc") + 0.4 * F.col("label")) * 100) / 100)
          .withColumn("fold", F.floor(u("fold") * 5).cast("int")))
    keep = ["customer_id", "split", "fold", "label", "future_spend", "threshold"]
    a = fp.select(*keep, F.lit("model_a").alias("model"), F.col("score_a").alias("score"),
                  (F.col("score_a") >= 0.5).cast("int").alias("prediction"))
    b = fp.select(*keep, F.lit("model_b").alias("model"), F.col("score_b").alias("score"),
                  (F.col("score_b") >= 0.5).cast("int").alias("prediction"))
    return a.unionByName(b)


# --- P01-P09 -----------------------------------------------------------------

@query("p01_temporal_split", f"""
WITH {S.LINES}
SELECT CASE WHEN invoice_ts < {C} THEN 'observation' ELSE 'future' END AS "window", count(*) AS rows,
       count(DISTINCT customer_id) AS customers, strftime(min(invoice_ts), '%Y-%m-%d %H:%M:%S') AS first_ts,
       strftime(max(invoice_ts), '%Y-%m-%d %H:%M:%S') AS last_ts
FROM lines GROUP BY 1""")
def p01_temporal_split(t):
    """Observation (< cutoff) and future (>= cutoff) windows over the lines."""
    return P.split_windows(retail.lines(t), CUTOFF)


@query("p02_split_integrity", f"""
WITH {S.LINES}
SELECT count(*) AS n_rows, count(*) FILTER (WHERE invoice_ts < {C}) AS n_obs,
       count(*) FILTER (WHERE invoice_ts >= {C}) AS n_future,
       max(invoice_ts) FILTER (WHERE invoice_ts < {C}) < min(invoice_ts) FILTER (WHERE invoice_ts >= {C}) AS no_overlap,
       count(*) FILTER (WHERE invoice_ts < {C}) + count(*) FILTER (WHERE invoice_ts >= {C}) = count(*) AS exhaustive,
       date_sub('day', min(invoice_ts) FILTER (WHERE invoice_ts < {C}), max(invoice_ts) FILTER (WHERE invoice_ts < {C}))
         AS obs_days,
       date_sub('day', min(invoice_ts) FILTER (WHERE invoice_ts >= {C}), max(invoice_ts) FILTER (WHERE invoice_ts >= {C}))
         AS future_days
FROM lines""")
def p02_split_integrity(t):
    return P.split_integrity(retail.lines(t), CUTOFF)


@query("p03_cold_start", f"""
WITH {S.LINES},
c AS (SELECT customer_id, count(*) FILTER (WHERE invoice_ts < {C}) AS o, count(*) FILTER (WHERE invoice_ts >= {C}) AS f
      FROM lines GROUP BY 1)
SELECT count(*) FILTER (WHERE o > 0) AS obs_customers, count(*) FILTER (WHERE f > 0) AS future_customers,
       count(*) FILTER (WHERE o = 0 AND f > 0) AS cold_start,
       {S.r6('count(*) FILTER (WHERE o = 0 AND f > 0) * 100.0 / count(*) FILTER (WHERE f > 0)')} AS cold_start_pct
FROM c""")
def p03_cold_start(t):
    c = P.cold_start(retail.lines(t), CUTOFF)
    return c.select("obs_customers", "future_customers", "cold_start", r6("cold_start_pct").alias("cold_start_pct"))


@query("p04_base_features", f"""
WITH {FEATURES}
SELECT customer_id, recency, frequency, monetary, tenure, {S.r6('avg_order_value')} AS avg_order_value FROM feat""")
def p04_base_features(t):
    """Recency, frequency, monetary, tenure, average order value from observed invoices."""
    return features(t).select("customer_id", "recency", "frequency", "monetary", "tenure",
                              r6("avg_order_value").alias("avg_order_value"))


@query("p05_future_spend", f"WITH {FEATURES} SELECT customer_id, future_spend FROM feat")
def p05_future_spend(t):
    """Spend in the future window; 0 for customers who did not come back."""
    return features(t).select("customer_id", "future_spend")


@query("p06_stratified_split", f"""
WITH {FEATURES}
SELECT split, CAST(future_spend > (SELECT quantile_cont(future_spend, 0.5) FROM feat) AS INTEGER) AS stratum,
       count(*) AS customers FROM sp GROUP BY 1, 2""")
def p06_stratified_split(t):
    """Exact 80/20 split of each stratum; sizes per split and stratum."""
    s = P.stratified_split(features(t))
    med = quantiles(s, "future_spend", [0.5], names=["_m"])
    return (s.crossJoin(F.broadcast(med))
            .groupBy("split", (F.col("future_spend") > F.col("_m")).cast("int").alias("stratum"))
            .agg(F.count(F.lit(1)).alias("customers")))


@query("p07_train_median_label", f"""
WITH {FEATURES}
SELECT any_value(threshold) AS threshold, count(*) AS n, CAST(sum(label) AS BIGINT) AS n_positive,
       count(*) FILTER (WHERE split = 'train') AS n_train, count(*) FILTER (WHERE split = 'test') AS n_test,
       {S.r6('count(*) FILTER (WHERE future_spend = 0) * 100.0 / count(*)')} AS zero_target_pct,
       {S.r6('greatest(sum(label) / count(*), 1 - sum(label) / count(*))')} AS majority_baseline
FROM lab""")
def p07_train_median_label(t):
    """Train-only median threshold, class balance, zero-spend %, majority baseline."""
    s = P.label_summary(labelled(t))
    return s.select("threshold", "n", "n_positive", "n_train", "n_test", r6("zero_target_pct").alias("zero_target_pct"),
                    r6("majority_baseline").alias("majority_baseline"))


@query("p08_threshold_leakage", f"""
WITH {FEATURES},
m AS (SELECT quantile_cont(future_spend, 0.5) AS median_all,
             quantile_cont(future_spend, 0.5) FILTER (WHERE split = 'train') AS median_train FROM sp)
SELECT median_all, median_train,
       count(*) FILTER (WHERE (future_spend > median_all) <> (future_spend > median_train)) AS labels_flipped,
       count(*) AS n
FROM sp CROSS JOIN m GROUP BY median_all, median_train""")
def p08_threshold_leakage(t):
    """All-data vs train-only median and the labels that would flip."""
    return P.threshold_leakage(P.stratified_split(features(t)))


@query("p09_leak_check", f"""
WITH {FEATURES},
hard AS (
  SELECT customer_id, date_sub('day', max(inv_ts), {C}) AS r2, count(*) AS f2,
         CAST(sum(inv_cents) AS DOUBLE) / 100 AS m2, date_sub('day', min(inv_ts), {C}) AS t2
  FROM inv WHERE inv_ts < {C} GROUP BY customer_id)
SELECT count(*) AS customers,
       count(*) FILTER (WHERE recency IS DISTINCT FROM r2 OR frequency IS DISTINCT FROM f2
                        OR monetary IS DISTINCT FROM m2 OR tenure IS DISTINCT FROM t2
                        OR avg_order_value IS DISTINCT FROM m2 / f2) AS mismatched,
       count(*) FILTER (WHERE recency < 0) AS negative_recency,
       count(*) FILTER (WHERE recency < 0 OR frequency < 0 OR monetary < 0 OR tenure < 0 OR avg_order_value < 0
                        OR future_spend < 0) AS negative_any,
       min(recency) AS min_recency, max(recency) AS max_recency
FROM feat FULL OUTER JOIN hard USING (customer_id)""")
def p09_leak_check(t):
    """Features rebuilt from hard-filtered rows are identical; no negative feature."""
    return P.leak_check(inv(t), CUTOFF)


# --- P10-P16 -----------------------------------------------------------------

OBS_INV = S.INVOICES + f""",
oinv AS (SELECT * FROM inv WHERE inv_ts < {C})"""


@query("p10_invoice_rollup", f"""
WITH {S.INVOICES}
SELECT customer_id, invoice, strftime(inv_ts, '%Y-%m-%d %H:%M:%S') AS inv_ts, inv_value, inv_items, n_lines FROM inv""")
def p10_invoice_rollup(t):
    """One row per customer x invoice from the canonical lines (generic operator)."""
    r = P.invoice_rollup(retail.lines(t))
    return r.select("customer_id", "invoice", F.date_format("inv_ts", "yyyy-MM-dd HH:mm:ss").alias("inv_ts"),
                    F.col("inv_value").cast("double").alias("inv_value"), "inv_items", "n_lines")


@query("p11_inter_purchase_gaps", f"""
WITH {OBS_INV},
g AS (SELECT customer_id, date_sub('day', lag(inv_ts) OVER (PARTITION BY customer_id ORDER BY inv_ts), inv_ts) AS gap
      FROM oinv)
SELECT customer_id, count(gap) AS n_gaps, {S.r6('avg(gap)')} AS ipt_mean, {S.r6('stddev_pop(gap)')} AS ipt_std
FROM g WHERE gap IS NOT NULL GROUP BY customer_id""")
def p11_inter_purchase_gaps(t):
    """Whole-day gaps between consecutive observed invoices: count, mean, population sd."""
    g = P.inter_purchase_gaps(inv(t).where(F.col("inv_ts") < F.lit(CUTOFF).cast("timestamp_ntz")))
    return g.select("customer_id", "n_gaps", r6("ipt_mean").alias("ipt_mean"), r6("ipt_std").alias("ipt_std"))


@query("p11_gaps_microsecond_events", """
WITH e AS (SELECT user_id AS customer_id, ts AS inv_ts FROM events),
g AS (SELECT customer_id, date_sub('day', lag(inv_ts) OVER (PARTITION BY customer_id ORDER BY inv_ts), inv_ts) AS gap
      FROM e)
SELECT customer_id, count(gap) AS n_gaps, CAST(sum(gap) AS BIGINT) AS total_days,
       """ + S.r6("avg(gap)") + """ AS ipt_mean, """ + S.r6("stddev_pop(gap)") + """ AS ipt_std
FROM g WHERE gap IS NOT NULL GROUP BY customer_id""")
def p11_gaps_microsecond_events(t):
    """Same gaps on microsecond event timestamps (24 h truncation is exercised)."""
    e = t.events.select(F.col("user_id").alias("customer_id"), F.col("ts").alias("inv_ts"))
    g = P.inter_purchase_gaps(e)
    return g.select("customer_id", "n_gaps", "total_days", r6("ipt_mean").alias("ipt_mean"),
                    r6("ipt_std").alias("ipt_std"))


@query("p12_invoice_stats", f"""
WITH {OBS_INV}
SELECT customer_id, CAST(max(inv_cents) AS DOUBLE) / 100 AS max_invoice_value,
       {S.r6('coalesce(stddev_samp(inv_value), 0.0)')} AS std_invoice_value,
       {S.r6('avg(CAST(inv_items AS DOUBLE))')} AS avg_items_per_invoice
FROM oinv GROUP BY customer_id""")
def p12_invoice_stats(t):
    s = P.invoice_stats(inv(t).where(F.col("inv_ts") < F.lit(CUTOFF).cast("timestamp_ntz")))
    return s.select("customer_id", "max_invoice_value", r6("std_invoice_value").alias("std_invoice_value"),
                    r6("avg_items_per_invoice").alias("avg_items_per_invoice"))


@query("p13_product_breadth", f"""
WITH {S.LINES}
SELECT customer_id, count(DISTINCT stock_code) AS distinct_products, CAST(sum(quantity) AS BIGINT) AS total_quantity
FROM lines WHERE invoice_ts < {C} GROUP BY customer_id""")
def p13_product_breadth(t):
    l_ = retail.lines(t)
    return P.product_breadth(l_.where(F.col("invoice_ts") < F.lit(CUTOFF).cast("timestamp_ntz")))


@query("p14_active_months", f"""
WITH {OBS_INV}
SELECT customer_id, count(DISTINCT date_trunc('month', inv_ts)) AS active_months FROM oinv GROUP BY customer_id""")
def p14_active_months(t):
    o = inv(t).where(F.col("inv_ts") < F.lit(CUTOFF).cast("timestamp_ntz"))
    return o.groupBy("customer_id").agg(F.countDistinct(F.date_trunc("MONTH", "inv_ts")).alias("active_months"))


RICH = FEATURES + f""",
oinv AS (SELECT * FROM inv WHERE inv_ts < {C}),
ag AS (SELECT customer_id, CAST(max(inv_cents) AS DOUBLE) / 100 AS max_invoice_value,
              coalesce(stddev_samp(inv_value), 0.0) AS std_invoice_value,
              avg(CAST(inv_items AS DOUBLE)) AS avg_items_per_invoice,
              count(DISTINCT date_trunc('month', inv_ts)) AS active_months,
              coalesce(CAST(sum(inv_cents) FILTER (WHERE inv_ts >= {C} - INTERVAL 90 DAY) AS DOUBLE) / 100, 0.0)
                AS spend_last90
       FROM oinv GROUP BY customer_id),
gp AS (SELECT customer_id, avg(gap) AS ipt_mean, stddev_pop(gap) AS ipt_std FROM (
         SELECT customer_id, date_sub('day', lag(inv_ts) OVER (PARTITION BY customer_id ORDER BY inv_ts), inv_ts) AS gap
         FROM oinv) WHERE gap IS NOT NULL GROUP BY customer_id),
br AS (SELECT customer_id, count(DISTINCT stock_code) AS distinct_products, CAST(sum(quantity) AS BIGINT) AS total_quantity
       FROM lines WHERE invoice_ts < {C} GROUP BY customer_id),
rich AS (
  SELECT f.customer_id, f.recency, f.frequency, f.monetary, f.avg_order_value, f.tenure,
         coalesce(gp.ipt_mean, CAST(f.tenure AS DOUBLE)) AS ipt_mean, coalesce(gp.ipt_std, 0.0) AS ipt_std,
         ag.max_invoice_value, ag.std_invoice_value, ag.avg_items_per_invoice, br.distinct_products,
         br.total_quantity, ag.active_months, ag.spend_last90,
         coalesce(CASE WHEN f.monetary = 0 THEN NULL ELSE ag.spend_last90 / f.monetary END, 0.0) AS momentum_ratio,
         coalesce(CASE WHEN f.tenure = 0 THEN NULL ELSE f.frequency / f.tenure END, 0.0) AS purchase_rate,
         f.future_spend
  FROM feat f LEFT JOIN ag USING (customer_id) LEFT JOIN gp USING (customer_id) LEFT JOIN br USING (customer_id))"""

RICH_DOUBLES = ["avg_order_value", "ipt_mean", "ipt_std", "std_invoice_value", "avg_items_per_invoice",
                "momentum_ratio", "purchase_rate"]


@query("p15_recent_spend", f"""
WITH {RICH}
SELECT customer_id, spend_last90, {S.r6('momentum_ratio')} AS momentum_ratio, {S.r6('purchase_rate')} AS purchase_rate
FROM rich""")
def p15_recent_spend(t):
    """Last-90-day spend, momentum = recent / monetary, purchase rate = frequency / tenure."""
    r = P.rich_features(inv(t), retail.lines(t), CUTOFF)
    return r.select("customer_id", "spend_last90", r6("momentum_ratio").alias("momentum_ratio"),
                    r6("purchase_rate").alias("purchase_rate"))


@query("p16_rich_features", f"""
WITH {RICH}
SELECT customer_id, recency, frequency, monetary, tenure, max_invoice_value, distinct_products, total_quantity,
       active_months, spend_last90, future_spend, {', '.join(f"{S.r6(c)} AS {c}" for c in RICH_DOUBLES)}
FROM rich""")
def p16_rich_features(t):
    """All 16 features + target in one table, observed rows only."""
    r = P.rich_features(inv(t), retail.lines(t), CUTOFF)
    return r.select("customer_id", "recency", "frequency", "monetary", "tenure", "max_invoice_value",
                    "distinct_products", "total_quantity", "active_months", "spend_last90", "future_spend",
                    *[r6(c).alias(c) for c in RICH_DOUBLES])


# --- P20-P28, P32, P37 on fixed predictions ---------------------------------

def _test(t):
    return fixed_predictions(t).where(F.col("split") == "test")


_MET = """
  SELECT model, count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
         count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
         count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
         count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn{extra}
  FROM preds WHERE {where} GROUP BY model{group}"""


def _metric_cols(prefix=""):
    def d(a, b):
        return f"CASE WHEN ({b}) = 0 THEN 0.0 ELSE ({a}) * 1.0 / ({b}) END"
    rec, spec = d("tp", "tp + fn"), d("tn", "tn + fp")
    return (f"{S.r6(d('tp + tn', 'tp + tn + fp + fn'))} AS accuracy, {S.r6(f'({rec} + {spec}) / 2')} AS balanced_accuracy, "
            f"{S.r6(d('tp', 'tp + fp'))} AS precision, {S.r6(rec)} AS recall, {S.r6(spec)} AS specificity, "
            f"{S.r6(d('2 * tp', '2 * tp + fp + fn'))} AS f1")


METRIC_NAMES = ["accuracy", "balanced_accuracy", "precision", "recall", "specificity", "f1"]


@query("p20_classification_metrics", f"""
WITH {FEATURES}, m AS ({_MET.format(extra='', where="split = 'test'", group='')})
SELECT model, tp, fp, tn, fn, tp + fp + tn + fn AS n, {_metric_cols()} FROM m""")
def p20_classification_metrics(t):
    """Held-out accuracy, balanced accuracy, precision, recall, specificity, F1 per model."""
    m = E.metrics(_test(t), by=["model"])
    return m.select("model", "tp", "fp", "tn", "fn", "n", *[r6(c).alias(c) for c in METRIC_NAMES])


@query("p20_class_report", f"""
WITH {FEATURES},
t AS (SELECT model, label, prediction FROM preds WHERE split = 'test'),
per AS (SELECT t.model, k.class, count(*) FILTER (WHERE label = k.class AND prediction = k.class) AS hit,
               count(*) FILTER (WHERE prediction = k.class) AS called, count(*) FILTER (WHERE label = k.class) AS support
        FROM t CROSS JOIN (VALUES (0), (1)) k(class) GROUP BY 1, 2),
m AS (SELECT model, class, support, CASE WHEN called = 0 THEN 0.0 ELSE CAST(hit AS DOUBLE) / called END AS prec,
             CASE WHEN support = 0 THEN 0.0 ELSE CAST(hit AS DOUBLE) / support END AS rec,
             CASE WHEN called + support = 0 THEN 0.0 ELSE 2.0 * CAST(hit AS DOUBLE) / (called + support) END AS f FROM per),
r AS (SELECT model, CAST(class AS VARCHAR) AS class, prec, rec, f, support FROM m
      UNION ALL SELECT model, 'macro avg', avg(prec), avg(rec), avg(f), sum(support) FROM m GROUP BY model
      UNION ALL SELECT model, 'weighted avg', sum(prec * support) / sum(support), sum(rec * support) / sum(support),
                       sum(f * support) / sum(support), sum(support) FROM m GROUP BY model)
SELECT model, class, {S.r6('prec')} AS precision, {S.r6('rec')} AS recall, {S.r6('f')} AS f1, CAST(support AS BIGINT) AS support FROM r""")
def p20_class_report(t):
    """Held-out precision, recall, F1 and support of each class and their means, per model."""
    m = E.class_report(_test(t), by=["model"])
    return m.select("model", "class", *[r6(c).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("p21_roc_auc", f"""
WITH {FEATURES},
s AS (SELECT model, score, CAST(sum(label) AS DOUBLE) AS pos, CAST(count(*) - sum(label) AS DOUBLE) AS neg
      FROM preds WHERE split = 'test' GROUP BY model, score),
c AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY model ORDER BY score
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM s)
SELECT model, {S.r6('sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg))')} AS roc_auc FROM c GROUP BY model""")
def p21_roc_auc(t):
    """Exact ROC-AUC (ties count one half) per model."""
    return E.roc_auc(_test(t), by=["model"]).select("model", r6("roc_auc").alias("roc_auc"))


@query("p22_confusion_matrix", f"""
WITH {FEATURES},
g AS (SELECT m.model, a.actual, p.predicted FROM (SELECT DISTINCT model FROM preds WHERE split = 'test') m,
      (VALUES (0), (1)) a(actual), (VALUES (0), (1)) p(predicted)),
c AS (SELECT model, label AS actual, prediction AS predicted, count(*) AS n FROM preds WHERE split = 'test'
      GROUP BY 1, 2, 3)
SELECT g.model, g.actual, g.predicted, coalesce(c.n, 0) AS count
FROM g LEFT JOIN c USING (model, actual, predicted)""")
def p22_confusion_matrix(t):
    return E.confusion_matrix(_test(t), by=["model"])


@query("p23_cv_fold_scores", f"""
WITH {FEATURES},
m AS ({_MET.format(extra=', fold', where="split = 'train'", group=', fold')}),
f AS (SELECT model, fold, CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2.0 * tp / (2 * tp + fp + fn) END AS f1 FROM m)
SELECT model, {S.r6('avg(f1)')} AS cv_f1_mean, {S.r6('stddev_pop(f1)')} AS cv_f1_std, count(*) AS folds
FROM f GROUP BY model""")
def p23_cv_fold_scores(t):
    """Per-fold F1 on the training split: mean and population sd per model."""
    tr = fixed_predictions(t).where(F.col("split") == "train")
    s = E.fold_scores(tr, by=["model"])
    return s.select("model", r6("cv_f1_mean").alias("cv_f1_mean"), r6("cv_f1_std").alias("cv_f1_std"), "folds")


COMPARISON = f"""
te AS ({_MET.format(extra='', where="split = 'test'", group='')}),
tr0 AS ({_MET.format(extra='', where="split = 'train'", group='')}),
tr AS (SELECT model, (tp + tn) * 1.0 / (tp + tn + fp + fn) AS train_accuracy FROM tr0),
s AS (SELECT model, score, CAST(sum(label) AS DOUBLE) AS pos, CAST(count(*) - sum(label) AS DOUBLE) AS neg
      FROM preds WHERE split = 'test' GROUP BY model, score),
c AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY model ORDER BY score
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM s),
auc AS (SELECT model, sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)) AS roc_auc FROM c GROUP BY model),
cmp AS (SELECT model, {_metric_cols()}, {S.r6('roc_auc')} AS roc_auc, {S.r6('train_accuracy')} AS train_accuracy,
       {S.r6('train_accuracy - (tp + tn) * 1.0 / (tp + tn + fp + fn)')} AS overfit_gap
FROM te JOIN tr USING (model) JOIN auc USING (model))"""


@query("p24_model_comparison", f"""
WITH {FEATURES}, {COMPARISON}
SELECT * FROM cmp""")
def p24_model_comparison(t):
    """Test metrics, AUC, train accuracy and train-test gap per model, best F1 first."""
    p = fixed_predictions(t)
    te = E.metrics(p.where(F.col("split") == "test"), by=["model"])
    tr = E.metrics(p.where(F.col("split") == "train"), by=["model"]).select(
        "model", F.col("accuracy").alias("train_accuracy"))
    auc = E.roc_auc(p.where(F.col("split") == "test"), by=["model"])
    j = te.join(tr, "model").join(auc, "model")
    return j.select("model", *[r6(c).alias(c) for c in METRIC_NAMES], r6("roc_auc").alias("roc_auc"),
                    r6("train_accuracy").alias("train_accuracy"),
                    r6(F.col("train_accuracy") - F.col("accuracy")).alias("overfit_gap")).orderBy(F.desc("f1"))


def _fold_f1(t):
    tr = fixed_predictions(t).where(F.col("split") == "train")
    m = E.metrics(tr, by=["model", "fold"])
    return (m.where(F.col("model") == "model_a").select("fold", "f1"),
            m.where(F.col("model") == "model_b").select("fold", "f1"))


@query("p25_paired_t", f"""
WITH {FEATURES},
m AS ({_MET.format(extra=', fold', where="split = 'train'", group=', fold')}),
f AS (SELECT model, fold, CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2.0 * tp / (2 * tp + fp + fn) END AS f1 FROM m),
d AS (SELECT a.fold, a.f1 - b.f1 AS d FROM f a JOIN f b ON a.fold = b.fold AND a.model = 'model_a' AND b.model = 'model_b'),
s AS (SELECT avg(d) AS mean_diff, var_samp(d) AS var_diff, count(*) AS k FROM d)
SELECT {S.r6('mean_diff')} AS mean_diff, {S.r6('var_diff')} AS var_diff, k,
       {S.r6('mean_diff / sqrt(var_diff / k)')} AS t,
       {S.r6('mean_diff / sqrt(var_diff * (1.0 / k + 1.0 / (k - 1)))')} AS t_corrected, k - 1 AS dof FROM s""")
def p25_paired_t(t):
    """Paired t on per-fold F1 differences, plain and Nadeau-Bengio corrected."""
    a, b = _fold_f1(t)
    s = E.paired_t(a, b)
    return s.select(r6("mean_diff").alias("mean_diff"), r6("var_diff").alias("var_diff"), "k",
                    r6("t").alias("t"), r6("t_corrected").alias("t_corrected"), "dof")


# closed form of the two-sided t tail for an even number of degrees of freedom (five folds: four)
_T_TAIL = """(1 - abs({t}) / sqrt(dof + {t} * {t}) * list_sum(list_transform(range(0, CAST(dof // 2 AS BIGINT)),
    lambda j: exp(lgamma(j + 0.5) - lgamma(j + 1) - lgamma(0.5)) * power(dof / (dof + {t} * {t}), j))))"""
T_STATISTICS = f"""
fm AS ({_MET.format(extra=', fold', where="split = 'train'", group=', fold')}),
ff AS (SELECT model, fold, CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2.0 * tp / (2 * tp + fp + fn) END AS f1 FROM fm),
fd AS (SELECT a.f1 - b.f1 AS d FROM ff a JOIN ff b ON a.fold = b.fold AND a.model = 'model_a' AND b.model = 'model_b'),
fs AS (SELECT avg(d) AS mean_diff, var_samp(d) AS var_diff, count(*) AS k FROM fd),
ts AS (SELECT mean_diff, var_diff, k, k - 1 AS dof, mean_diff / sqrt(var_diff / k) AS t,
              mean_diff / sqrt(var_diff * (1.0 / k + 1.0 / (k - 1))) AS t_corrected FROM fs)"""


@query("p25_paired_t_pvalues", f"""
WITH {FEATURES}, {T_STATISTICS}
SELECT {S.r6('mean_diff')} AS mean_diff, {S.r6('var_diff')} AS var_diff, k, {S.r6('t')} AS t,
       {S.r6('t_corrected')} AS t_corrected, dof, {S.r6(_T_TAIL.format(t='t'))} AS p,
       {S.r6(_T_TAIL.format(t='t_corrected'))} AS p_corrected FROM ts""")
def p25_paired_t_pvalues(t):
    """Two-sided p-values of both t statistics (t distribution, k - 1 dof)."""
    a, b = _fold_f1(t)
    s = E.with_t_pvalues(E.paired_t(a, b))
    return s.select(*[r6(c).alias(c) for c in ("mean_diff", "var_diff")], "k", r6("t").alias("t"),
                    r6("t_corrected").alias("t_corrected"), "dof", r6("p").alias("p"), r6("p_corrected").alias("p_corrected"))


MCNEMAR = """
j AS (SELECT a.label AS y, a.prediction AS pa, b.prediction AS pb
      FROM preds a JOIN preds b ON a.customer_id = b.customer_id AND a.model = 'model_a' AND b.model = 'model_b'
      WHERE a.split = 'test'),
bc AS (SELECT count(*) FILTER (WHERE pa = y AND pb <> y) AS b, count(*) FILTER (WHERE pa <> y AND pb = y) AS c FROM j),
tail AS (SELECT sum(exp(lgamma(b + c + 1) - lgamma(i + 1) - lgamma(b + c - i + 1) - (b + c) * ln(2))) AS p1
         FROM bc, range(0, CAST(least(b, c) + 1 AS BIGINT)) r(i))"""
MCNEMAR_SQL = f"""
WITH {FEATURES}, {MCNEMAR}
SELECT b, c, CASE WHEN b + c = 0 THEN 1.0 ELSE {S.r6('least(1.0, 2 * p1)')} END AS p_value FROM bc, tail"""


@query("p26_mcnemar", MCNEMAR_SQL)
def p26_mcnemar(t):
    """Exact McNemar on the held-out split: discordant counts and binomial p."""
    p = _test(t)
    m = E.mcnemar(p.where(F.col("model") == "model_a"), p.where(F.col("model") == "model_b"), "customer_id")
    return m.select("b", "c", r6("p_value").alias("p_value"))


@query("p27_distinguishable", f"""
WITH {FEATURES}, {T_STATISTICS}, {MCNEMAR},
v AS (SELECT {_T_TAIL.format(t='t_corrected')} AS p_corrected, CASE WHEN b + c = 0 THEN 1.0 ELSE least(1.0, 2 * p1) END AS mcnemar_p
      FROM ts, bc, tail)
SELECT {S.r6('p_corrected')} AS p_corrected, {S.r6('mcnemar_p')} AS mcnemar_p,
       p_corrected > 0.05 AND mcnemar_p > 0.05 AS indistinguishable FROM v""")
def p27_distinguishable(t):
    """Verdict: models indistinguishable when both corrected-t and McNemar p > 0.05."""
    a, b = _fold_f1(t)
    tp = E.with_t_pvalues(E.paired_t(a, b)).select("p_corrected")
    p = materialize(_test(t))
    mc = E.mcnemar(p.where(F.col("model") == "model_a"), p.where(F.col("model") == "model_b"), "customer_id")
    return tp.crossJoin(mc.select(F.col("p_value").alias("mcnemar_p"))).withColumn(
        "indistinguishable", (F.col("p_corrected") > 0.05) & (F.col("mcnemar_p") > 0.05)) \
        .withColumn("p_corrected", r6("p_corrected")).withColumn("mcnemar_p", r6("mcnemar_p"))


@query("p28_spend_bands", f"""
WITH {FEATURES},
x AS (SELECT future_spend AS s, threshold AS m, CAST(prediction = label AS INTEGER) AS ok FROM preds
      WHERE split = 'test' AND model = 'model_a'),
b AS (SELECT CASE WHEN s = 0 THEN '1 zero' WHEN s > 0 AND s < m * 0.5 THEN '2 below 0.5x'
                  WHEN s >= m * 0.5 AND s <= m * 2 THEN '3 0.5x-2x' WHEN s > m * 2 AND s <= m * 10 THEN '4 2x-10x'
                  WHEN s > m * 10 THEN '5 above 10x' END AS band, ok FROM x)
SELECT band, count(*) AS n, {S.r6('avg(ok)')} AS accuracy FROM b WHERE band IS NOT NULL GROUP BY band
UNION ALL SELECT 'ALL', count(*), {S.r6('avg(ok)')} FROM b""")
def p28_spend_bands(t):
    """Held-out accuracy by actual future spend relative to the threshold, plus ALL."""
    p = _test(t).where(F.col("model") == "model_a").withColumn("correct", F.col("prediction") == F.col("label"))
    return E.spend_bands(p, "future_spend", "threshold").select("band", "n", r6("accuracy").alias("accuracy"))


def _state_labels(t):
    return labelled(t).join(retail.customer_states(t), "customer_id", "left")


CHI_CELLS = f"""{S.STATES.strip()},
x AS (SELECT s.state, l.label FROM lab l LEFT JOIN states s USING (customer_id)),
o AS (SELECT state, label, count(*) AS o FROM x GROUP BY 1, 2),
ra AS (SELECT state, sum(o) AS ra FROM o GROUP BY 1), rb AS (SELECT label, sum(o) AS rb FROM o GROUP BY 1),
n AS (SELECT sum(o) AS n FROM o),
e AS (SELECT ra.state, rb.label, ra.ra * rb.rb * 1.0 / n.n AS e, coalesce(o.o, 0) AS o
      FROM ra CROSS JOIN rb CROSS JOIN n LEFT JOIN o ON o.state = ra.state AND o.label = rb.label)"""


@query("p32_chi_square", f"""
WITH {FEATURES}, {CHI_CELLS}
SELECT {S.r6('sum(power(o - e, 2) / e)')} AS chi2, (count(DISTINCT state) - 1) * (count(DISTINCT label) - 1) AS dof
FROM e""")
def p32_chi_square(t):
    """Chi-square independence of state vs label (statistic and dof)."""
    c = E.chi_square(_state_labels(t), "state", "label")
    return c.select(r6("chi2").alias("chi2"), "dof")


# closed form of the chi-square tail for an even number of degrees of freedom (25 states and two labels: 24)
@query("p32_chi_square_pvalue", f"""
WITH {FEATURES}, {CHI_CELLS},
c2 AS (SELECT sum(power(o - e, 2) / e) AS chi2, (count(DISTINCT state) - 1) * (count(DISTINCT label) - 1) AS dof FROM e)
SELECT {S.r6('chi2')} AS chi2, dof, {S.r6("list_sum(list_transform(range(0, CAST(dof // 2 AS BIGINT)), lambda j: exp(j * ln(chi2 / 2) - chi2 / 2 - lgamma(j + 1))))")} AS p_value FROM c2""")
def p32_chi_square_pvalue(t):
    """... with the chi-square tail probability."""
    c = E.chi_square(_state_labels(t), "state", "label")
    return c.select(r6("chi2").alias("chi2"), "dof", r6("p_value").alias("p_value"))


@query("p37_top_quartile_target", f"""
WITH {FEATURES},
q AS (SELECT quantile_cont(future_spend, 0.75) AS q75 FROM feat)
SELECT {S.r6('q75')} AS q75, count(*) AS n, count(*) FILTER (WHERE future_spend > q75) AS n_positive,
       {S.r6('greatest(count(*) FILTER (WHERE future_spend > q75) * 1.0 / count(*), 1 - count(*) FILTER (WHERE future_spend > q75) * 1.0 / count(*))')}
         AS majority_baseline
FROM feat CROSS JOIN q GROUP BY q75""")
def p37_top_quartile_target(t):
    """Top-quartile (75th percentile) target: threshold, positives, majority baseline."""
    f = features(t)
    q = quantiles(f, "future_spend", [0.75], names=["q75"])
    j = f.crossJoin(F.broadcast(q))
    a = j.agg(F.first("q75").alias("q75"), F.count(F.lit(1)).alias("n"),
              F.count_if(F.col("future_spend") > F.col("q75")).alias("n_positive"))
    pos = F.col("n_positive") / F.col("n")
    return a.select(r6("q75").alias("q75"), "n", "n_positive", r6(F.greatest(pos, 1 - pos)).alias("majority_baseline"))
