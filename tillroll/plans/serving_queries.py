"""Q01-Q14 serving queries, V09-V10 artefact checks, S01/S04/S05 round trips.

The customer table is the rule-clustered segment table (R08) and the
prediction table is the fixed-score 'model_a' of the evaluation queries, so
every number here has an independent SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import r6
from ..operators import checks as V
from ..operators import evaluate as E
from ..operators import serve as Q
from ..operators import validity as K
from ..operators import rfm as R
from ..session import materialize
from ..sources import files, retail
from . import sqltext as S
from .cleaning_queries import ADAPTED, RAW, adapted
from .feature_queries import COMPARISON, FEATURES, fixed_predictions, labelled
from .registry import query
from .segment_queries import RULE_TAIL, _rule_profile

_SHORT = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in Q.SEGMENT_SHORT_NAMES.items())
_ORDER = " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(Q.SEGMENT_ORDER))

SERVE = FEATURES + "," + S.RFM_TAIL + "," + RULE_TAIL + f""",
cust AS (SELECT c.customer_id, c.recency, c.frequency, c.monetary, c.state, c.cluster, f.segment_label,
                CASE f.segment_label {_SHORT} END AS segment
         FROM cl c LEFT JOIN final f USING (cluster)),
pr AS (SELECT customer_id, prediction AS predicted, score AS probability, label AS actual,
              future_spend AS actual_future_spend,
              CASE WHEN split = 'test' THEN 'held-out test' ELSE 'train' END AS data_split,
              prediction = label AS correct
       FROM preds WHERE model = 'model_a'),
segtot AS (SELECT segment, count(*) AS customers, CAST(sum(CAST(monetary AS DECIMAL(18, 2))) AS DOUBLE) AS revenue,
                  CAST(sum(CAST(monetary AS DECIMAL(18, 2))) AS DOUBLE) / count(*) AS avg_value,
                  count(*) * 100.0 / sum(count(*)) OVER () AS pct_customers,
                  CAST(sum(CAST(monetary AS DECIMAL(18, 2))) AS DOUBLE) * 100
                    / CAST(sum(sum(CAST(monetary AS DECIMAL(18, 2)))) OVER () AS DOUBLE) AS pct_revenue,
                  CASE segment {_ORDER} ELSE 4 END AS display_order
           FROM cust GROUP BY segment),
{COMPARISON}"""

SEGMENTS = ["Champions", "At-Risk High Value"]
STATES = ["NATION_1", "NATION_2", "NATION_3", "NATION_4", "NATION_5"]
_DSUM = "CAST(sum(CAST(monetary AS DECIMAL(18, 2))) AS DOUBLE)"
_SEG_SQL = ", ".join(f"'{s}'" for s in SEGMENTS)
_ST_SQL = ", ".join(f"'{s}'" for s in STATES)


def customers(t):
    r, cl, prof, med = _rule_profile(t)
    return Q.short_names(R.assign_labels(cl, R.label_segments(prof, r, med)))


def predictions(t):
    p = fixed_predictions(t).where(F.col("model") == "model_a")
    return p.select("customer_id", F.col("prediction").alias("predicted"), F.col("score").alias("probability"),
                    F.col("label").alias("actual"), F.col("future_spend").alias("actual_future_spend"),
                    F.when(F.col("split") == "test", F.lit("held-out test")).otherwise(F.lit("train")).alias("data_split"),
                    (F.col("prediction") == F.col("label")).alias("correct"))


def comparison(t):
    p = fixed_predictions(t)
    te = E.metrics(p.where(F.col("split") == "test"), by=["model"])
    tr = E.metrics(p.where(F.col("split") == "train"), by=["model"]).select(
        "model", F.col("accuracy").alias("train_accuracy"))
    auc = E.roc_auc(p.where(F.col("split") == "test"), by=["model"])
    return te.join(tr, "model").join(auc, "model").withColumn(
        "overfit_gap", F.col("train_accuracy") - F.col("accuracy"))


@query("q01_segment_names", f"WITH {SERVE} SELECT customer_id, segment_label, segment FROM cust")
def q01_segment_names(t):
    """Long -> short segment names; an unmapped label fails the query."""
    return customers(t).select("customer_id", "segment_label", "segment")


@query("q02_filtered_view", f"""
WITH {SERVE} SELECT customer_id, segment, state FROM cust WHERE segment IN ({_SEG_SQL}) AND state IN ({_ST_SQL})""")
def q02_filtered_view(t):
    return Q.filter_view(customers(t), SEGMENTS, STATES).select("customer_id", "segment", "state")


@query("q03_kpis", f"""
WITH {SERVE},
v AS (SELECT * FROM cust WHERE segment IN ({_SEG_SQL}) AND state IN ({_ST_SQL}))
SELECT count(*) AS customers, {S.r6(_DSUM)} AS revenue, {S.r6(_DSUM + ' / count(*)')} AS avg_value,
       count(DISTINCT segment) AS segments,
       {S.r6(_DSUM + ' * 100 / (SELECT ' + _DSUM + ' FROM cust)')} AS revenue_share_pct FROM v""")
def q03_kpis(t):
    """KPI row of a filtered view, with its share of all revenue."""
    c = customers(t)
    k = Q.kpis(Q.filter_view(c, SEGMENTS, STATES), c)
    return k.select("customers", r6("revenue").alias("revenue"), r6("avg_value").alias("avg_value"), "segments",
                    r6("revenue_share_pct").alias("revenue_share_pct"))


_TOT_COLS = ["revenue", "avg_value", "pct_customers", "pct_revenue"]


@query("q04_segment_totals", f"""
WITH {SERVE}
SELECT segment, customers, {', '.join(f"{S.r6(c)} AS {c}" for c in _TOT_COLS)}, display_order FROM segtot""")
def q04_segment_totals(t):
    """Customers, revenue, average value and shares per segment, fixed display order."""
    s = Q.segment_totals(customers(t))
    return s.select("segment", "customers", *[r6(c).alias(c) for c in _TOT_COLS], "display_order")


@query("q05_headline", f"""
WITH {SERVE}
SELECT segment, customers, {S.r6('revenue')} AS revenue, {S.r6('pct_customers')} AS pct_customers,
       {S.r6('pct_revenue')} AS pct_revenue FROM segtot WHERE segment IN ('Champions', 'At-Risk High Value')""")
def q05_headline(t):
    """Champions' share of customers and revenue; revenue at risk (unfiltered)."""
    h = Q.headline(customers(t))
    return h.select("segment", "customers", *[r6(c).alias(c) for c in ["revenue", "pct_customers", "pct_revenue"]])


@query("q06_state_stats", f"""
WITH {SERVE}
SELECT state, count(*) AS customers, {S.r6('avg(monetary)')} AS mean, {S.r6('stddev_samp(monetary)')} AS sd,
       {S.r6('coalesce(1.96 * stddev_samp(monetary) / sqrt(count(*)), 0.0)')} AS ci FROM cust GROUP BY state""")
def q06_state_stats(t):
    """Per-state n, mean value, sample sd and 95 % interval half-width."""
    s = Q.state_stats(customers(t))
    return s.select("state", "customers", r6("mean").alias("mean"), r6("sd").alias("sd"), r6("ci").alias("ci"))


@query("q07_states_covering_mean", f"""
WITH {SERVE},
per_state AS (SELECT state, avg(monetary) AS mean, coalesce(1.96 * stddev_samp(monetary) / sqrt(count(*)), 0.0) AS ci
       FROM cust GROUP BY state),
om AS (SELECT avg(monetary) AS overall FROM cust)
SELECT count(*) FILTER (WHERE mean - ci <= overall AND mean + ci >= overall) AS covering, count(*) AS states,
       {S.r6('any_value(overall)')} AS overall_mean FROM per_state CROSS JOIN om""")
def q07_states_covering_mean(t):
    q = Q.states_covering_mean(customers(t))
    return q.select("covering", "states", r6("overall_mean").alias("overall_mean"))


@query("q08_segment_means", f"""
WITH {SERVE}
SELECT segment, {S.r6('avg(recency)')} AS recency, {S.r6('avg(frequency)')} AS frequency,
       {S.r6('avg(monetary)')} AS monetary FROM cust GROUP BY segment""")
def q08_segment_means(t):
    m = Q.segment_means(customers(t))
    return m.select("segment", *[r6(c).alias(c) for c in R.RFM])


@query("q09_context_sample", f"""
WITH {SERVE}
SELECT customer_id, segment FROM cust ORDER BY md5(concat_ws('|', customer_id, '42')) LIMIT 2500""")
def q09_context_sample(t):
    """Repeatable sample of min(2500, n) customers (hash order)."""
    return Q.context_sample(customers(t)).select("customer_id", "segment")


_LIST_SQL = f"""
l AS (SELECT p.customer_id, c.segment, c.state, p.probability AS confidence,
             CASE WHEN p.predicted = 1 THEN 'High spender' ELSE 'Low / no spend' END AS prediction,
             p.actual_future_spend, p.data_split, p.correct
      FROM pr p LEFT JOIN cust c USING (customer_id) WHERE p.probability >= 0.5)"""


@query("q10_contact_list", f"WITH {SERVE}, {_LIST_SQL} SELECT * FROM l")
def q10_contact_list(t):
    """Scored customers with probability >= 0.5, segment and state attached, most likely first."""
    return Q.contact_list(predictions(t), customers(t), 0.5)


@query("q10_contact_list_filtered", f"""
WITH {SERVE}, {_LIST_SQL}
SELECT * FROM l WHERE segment IN ({_SEG_SQL}) AND data_split = 'held-out test'""")
def q10_contact_list_filtered(t):
    """... restricted to two segments and to held-out customers."""
    return Q.contact_list(predictions(t), customers(t), 0.5, segments=SEGMENTS, held_out_only=True)


@query("q11_contact_metrics", f"""
WITH {SERVE}, {_LIST_SQL}
SELECT count(*) AS customers, {S.r6('avg(confidence)')} AS avg_confidence,
       {S.r6('avg(CAST(correct AS INTEGER))')} AS accuracy,
       count(*) FILTER (WHERE data_split = 'train') AS train_rows FROM l""")
def q11_contact_metrics(t):
    """Size, mean confidence, accuracy and in-sample rows of the contact list."""
    m = Q.contact_metrics(Q.contact_list(predictions(t), customers(t), 0.5))
    return m.select("customers", r6("avg_confidence").alias("avg_confidence"), r6("accuracy").alias("accuracy"),
                    "train_rows")


_FEATS = ["recency", "frequency", "monetary", "avg_order_value", "tenure"]
_FRIENDLY = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in Q.FRIENDLY_FEATURES.items())


def correlation_importance(t):
    """Importance table stand-in with an exact SQL form: Pearson correlation of
    log1p(feature) with the label on the training split."""
    tr = labelled(t).where(F.col("split") == "train")
    a = tr.agg(*[F.corr(F.log1p(F.col(f).cast("double")), F.col("label").cast("double")).alias(f) for f in _FEATS])
    return a.select(F.explode(F.array(*[F.struct(F.lit("correlation").alias("model"), F.lit(f).alias("feature"),
                                                 F.col(f).alias("importance")) for f in _FEATS])).alias("r")) \
        .select("r.*")


@query("q12_driver_table", f"""
WITH {SERVE},
imp AS ({' UNION ALL '.join(f"SELECT '{f}' AS feature, corr(ln(1 + CAST({f} AS DOUBLE)), CAST(label AS DOUBLE)) AS importance FROM lab WHERE split = 'train'" for f in _FEATS)})
SELECT feature, coalesce(CASE feature {_FRIENDLY} END, feature) AS label, {S.r6('importance')} AS importance,
       CASE WHEN importance > 0 THEN 'Raises' ELSE 'Lowers' END AS direction FROM imp""")
def q12_driver_table(t):
    """Features with plain names and the direction they push the prediction."""
    d = Q.driver_table(correlation_importance(t), "correlation")
    return d.select("feature", "label", r6("importance").alias("importance"), "direction")


@query("q13_comparison_long", f"""
WITH {SERVE}
SELECT model, metric, value FROM (
  SELECT model, 'accuracy' AS metric, accuracy AS value FROM cmp UNION ALL
  SELECT model, 'precision', precision FROM cmp UNION ALL SELECT model, 'recall', recall FROM cmp UNION ALL
  SELECT model, 'f1', f1 FROM cmp)""")
def q13_comparison_long(t):
    """Model comparison, wide -> long (model, metric, value)."""
    c = comparison(t).select("model", *[r6(m).alias(m) for m in ["accuracy", "precision", "recall", "f1"]])
    return Q.comparison_long(c)


def _fmt(expr: str, d: int) -> str:
    return f"format('{{:,.{d}f}}', floor(({expr}) * {10 ** d}.0 + 0.5) / {10 ** d}.0)"


@query("q14_briefing", f"""
WITH {SERVE},
sil_e AS (SELECT customer_id AS id, cluster, [(r - avg(r) OVER ()) / stddev_pop(r) OVER (),
                 (f - avg(f) OVER ()) / stddev_pop(f) OVER (), (m - avg(m) OVER ()) / stddev_pop(m) OVER ()] AS x
          FROM (SELECT customer_id, cluster, ln(1 + CAST(recency AS DOUBLE)) AS r,
                       ln(1 + CAST(frequency AS DOUBLE)) AS f, ln(1 + monetary) AS m FROM cl)),
sil_d AS (SELECT a.id, a.cluster AS own, b.cluster AS other, avg(power(list_distance(a.x, b.x), 2)) AS md
          FROM sil_e a JOIN sil_e b ON a.id <> b.id GROUP BY 1, 2, 3),
sil_p AS (SELECT id, max(CASE WHEN other = own THEN md END) AS a, min(CASE WHEN other <> own THEN md END) AS b
          FROM sil_d GROUP BY id),
sil AS (SELECT avg(CASE WHEN a IS NULL OR b IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END) AS s FROM sil_p)
SELECT 'segments' AS section, display_order AS ord,
       '- ' || segment || ': ' || format('{{:,}}', customers) || ' customers (' || {_fmt('pct_customers', 1)}
       || '% of base), ' || {_fmt('pct_revenue', 1)} || '% of revenue, average value RM ' || {_fmt('avg_value', 0)}
       || '.' AS line FROM segtot
UNION ALL
SELECT 'models', 0, '- ' || model || ': accuracy ' || {_fmt('accuracy', 3)} || ', F1 ' || {_fmt('f1', 3)}
       || ', ROC-AUC ' || {_fmt('roc_auc', 3)} || ', train-test gap ' || {_fmt('overfit_gap', 4)} FROM cmp
UNION ALL
SELECT 'totals', 0, 'TOTALS: ' || format('{{:,}}', count(*)) || ' customers, RM ' || {_fmt(_DSUM, 0)}
       || ' total revenue.' FROM cust
UNION ALL
SELECT 'validity', 0, 'CLUSTER VALIDITY: silhouette (squared) ' || {_fmt('s', 3)} || '.' FROM sil""")
def q14_briefing(t):
    """Plain-text briefing lines, every number taken from the tables."""
    c = customers(t)
    z = R.rfm_scaled(c)
    sil = K.silhouette_score_sq(K.column_points(z, "customer_id", [f"{x}_z" for x in R.RFM]))
    return Q.briefing(Q.segment_totals(c), comparison(t), c, sil)


# --- V09 / V10 ----------------------------------------------------------------

@query("v09_artefact_contract", f"""
WITH {SERVE}
SELECT (SELECT count(DISTINCT cluster) FROM cust) = 4 AS four_clusters,
       (SELECT count(*) FROM cust WHERE segment_label IS NULL) = 0 AS labels_present,
       (SELECT count(*) FROM cmp WHERE model IN ('model_a', 'model_b')) = 2 AS models_present,
       (SELECT count(*) FROM cmp WHERE f1 IS NULL OR roc_auc IS NULL OR accuracy IS NULL) = 0 AS metrics_present,
       (SELECT bool_and(list_has_all(json_keys(to_json(c)), ['customer_id', 'recency', 'frequency', 'monetary', 'state', 'cluster', 'segment_label']))
        FROM cust c)
         AND (SELECT bool_and(list_has_all(json_keys(to_json(m)), ['f1', 'roc_auc', 'accuracy'])) FROM cmp m) AS columns_present""")
def v09_artefact_contract(t):
    """Contract checks over the saved tables: columns, cluster count, labels, models, metrics."""
    c = customers(t)
    cmp = comparison(t)
    required = {"customer_id", "recency", "frequency", "monetary", "state", "cluster", "segment_label"}
    cols_ok = required.issubset(set(c.columns)) and {"f1", "roc_auc", "accuracy"}.issubset(set(cmp.columns))
    a = c.agg((F.countDistinct("cluster") == 4).alias("four_clusters"),
              (F.count_if(F.col("segment_label").isNull()) == 0).alias("labels_present"))
    b = cmp.agg((F.count_if(F.col("model").isin("model_a", "model_b")) == 2).alias("models_present"),
                (F.count_if(F.col("f1").isNull() | F.col("roc_auc").isNull() | F.col("accuracy").isNull()) == 0)
                .alias("metrics_present"))
    return a.crossJoin(b).withColumn("columns_present", F.lit(cols_ok))


@query("v10_success_criteria", f"""
WITH {SERVE},
best AS (SELECT model, accuracy FROM cmp ORDER BY f1 DESC, model LIMIT 1),
sil_log AS (SELECT customer_id, cluster, ln(1 + CAST(recency AS DOUBLE)) AS r, ln(1 + CAST(frequency AS DOUBLE)) AS f,
                   ln(1 + monetary) AS m FROM cl),
sil_pts AS (SELECT customer_id AS id, cluster,
                   [(r - avg(r) OVER ()) / stddev_pop(r) OVER (), (f - avg(f) OVER ()) / stddev_pop(f) OVER (),
                    (m - avg(m) OVER ()) / stddev_pop(m) OVER ()] AS x FROM sil_log),
sil_mean AS (SELECT a.id, a.cluster AS own, b.cluster AS other, avg(list_distance(a.x, b.x)) AS md
             FROM sil_pts a JOIN sil_pts b ON a.id <> b.id WHERE a.id % 50 = 0 GROUP BY 1, 2, 3),
sil_row AS (SELECT id, max(CASE WHEN other = own THEN md END) AS a, min(CASE WHEN other <> own THEN md END) AS b FROM sil_mean GROUP BY id),
sil AS (SELECT avg(CASE WHEN a IS NULL OR b IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END) AS silhouette FROM sil_row)
SELECT model AS best_model, {S.r6('accuracy')} AS best_accuracy, accuracy >= 0.75 AS accuracy_target_met,
       {S.r6('silhouette')} AS silhouette, silhouette >= 0.50 AS silhouette_target_met FROM best CROSS JOIN sil""")
def v10_success_criteria(t):
    """Best-F1 model and whether its accuracy reaches the 0.75 target; Euclidean silhouette of the segments (customers with
    an id divisible by 50 against all) and whether it reaches 0.50."""
    c = comparison(t)
    b = c.agg(F.max_by(F.struct("model", "accuracy"), F.struct("f1", F.lit(0) - F.lit(0))).alias("b"))
    z = R.rfm_scaled(_rule_profile(t)[1])
    s = K.silhouette_score_euclidean(K.column_points(z, "customer_id", [f"{x}_z" for x in R.RFM]))
    return b.crossJoin(F.broadcast(s)).select(
        F.col("b.model").alias("best_model"), r6("b.accuracy").alias("best_accuracy"),
        (F.col("b.accuracy") >= 0.75).alias("accuracy_target_met"), r6("silhouette").alias("silhouette"),
        (F.col("silhouette") >= 0.50).alias("silhouette_target_met"))


# --- S01 / S04 / S05 round trips ----------------------------------------------------

@query("s01_csv_extracts", f"WITH {RAW} SELECT _source, count(*) AS rows, count(*) FILTER (WHERE customer_id IS NULL) AS null_keys FROM raw GROUP BY _source")
def s01_csv_extracts(t):
    """Raw extracts written as ISO-8859-1 CSV (one folder per extract), read back
    with header, charset and an explicit schema."""
    spark = t.spark
    raw = retail.raw_extracts(t)
    base = files.artefact_dir(spark, "extracts")
    paths = []
    for src in ("extract_a", "extract_b"):
        p = f"{base}/{src}"
        files.write_csv(raw.where(F.col("_source") == src).drop("_source"), p)
        paths.append(p)
    back = files.read_csv(spark, paths)
    return back.groupBy("_source").agg(F.count(F.lit(1)).alias("rows"),
                                       F.count_if(F.col("customer_id").isNull()).alias("null_keys"))


@query("s01_line_numbers", f"""
WITH {RAW} SELECT _source, line_id, row_number() OVER (PARTITION BY _source ORDER BY line_id) AS line_number FROM raw""")
def s01_line_numbers(t):
    """The extracts written in the order of their line ids, in as many files as the sort gives, and read back with the
    number of each line."""
    base = files.artefact_dir(t.spark, "extracts")
    raw = materialize(retail.raw_extracts(t))
    paths = [files.write_csv(raw.where(F.col("_source") == src).drop("_source").orderBy("line_id"), f"{base}/{src}")
             for src in ("extract_a", "extract_b")]
    return files.read_numbered_csv(t.spark, paths).select("_source", "line_id", "line_number")


_SWAPPED = "CASE line_id WHEN (SELECT min(line_id) FROM clean) THEN 2 WHEN (SELECT max(line_id) FROM clean) THEN 0 ELSE 1 END"


@query("v04_row_position", f"""
WITH {ADAPTED},
b AS (SELECT row_number() OVER (ORDER BY line_id) AS n, line_id, customer_id FROM clean),
a AS (SELECT 'adapted' AS copy, row_number() OVER (ORDER BY line_id) AS n, line_id, customer_id FROM final
      UNION ALL
      SELECT 'swapped' AS copy, row_number() OVER (ORDER BY {_SWAPPED}, line_id) AS n, line_id, customer_id FROM final),
bc AS (SELECT * FROM b CROSS JOIN (VALUES ('adapted'), ('swapped')) c(copy)),
j AS (SELECT coalesce(b.copy, a.copy) AS copy, b.n AS bn, a.n AS an, b.customer_id AS bk, a.customer_id AS ak,
             b.line_id AS bl, a.line_id AS al FROM bc b FULL OUTER JOIN a ON a.n = b.n AND a.copy = b.copy)
SELECT copy, count(*) FILTER (WHERE bn IS NULL OR an IS NULL) AS unmatched_lines,
       count(*) FILTER (WHERE bk IS DISTINCT FROM ak) AS diff_customer_id, count(*) FILTER (WHERE bl IS DISTINCT FROM al) AS diff_line_id,
       count(*) FILTER (WHERE bn IS NULL OR an IS NULL OR bk IS DISTINCT FROM ak OR bl IS DISTINCT FROM al) = 0 AS same_sequence
FROM j GROUP BY copy""")
def v04_row_position(t):
    """Same key at the same line of the cleaned file, of its adapted copy and of a copy whose first and last lines
    are exchanged; the line numbers come from reading the three files back."""
    c, a = adapted(t)
    base, key = files.artefact_dir(t.spark, "positions"), ["line_id", "customer_id"]
    a = a.select(*key)  # row by row from the cleaned lines, which are written
    ends = materialize(a.agg(F.min("line_id").alias("first"), F.max("line_id").alias("last")))
    exchanged = a.crossJoin(F.broadcast(ends)).orderBy(
        F.when(F.col("line_id") == F.col("first"), 2).when(F.col("line_id") == F.col("last"), 0).otherwise(1), "line_id")
    paths = [files.write_csv(df.select(*key), f"{base}/{name}") for name, df in (
        ("cleaned", c.orderBy("line_id")), ("adapted", a.orderBy("line_id")), ("swapped", exchanged))]
    schema = T.StructType([T.StructField(k, T.StringType()) for k in key])
    lines = files.read_numbered_csv(t.spark, paths, schema)  # written once by itself
    one = lambda name: lines.where(F.col("_source") == name)

    def compared(name):
        d = V.compare_columns(one("cleaned"), one(name), "line_number", [("customer_id", "customer_id"), ("line_id", "line_id")])
        return d.select(F.lit(name).alias("copy"), "*", (F.greatest("unmatched_lines", "diff_customer_id", "diff_line_id") == 0).alias("same_sequence"))
    return compared("adapted").unionByName(compared("swapped"))


@query("s04_artefact_roundtrip", f"WITH {S.RFM} SELECT customer_id, recency, frequency, monetary, state FROM rfm_s")
def s04_artefact_roundtrip(t):
    """RFM table written to a new artefact folder (parquet) and read back."""
    spark = t.spark
    from .segment_queries import rfm_table
    path = files.write_artefact(rfm_table(t), files.artefact_dir(spark, "rfm"))
    return files.read_artefact(spark, path)


@query("s05_json_record", f"""
WITH {FEATURES}
SELECT any_value(threshold) AS threshold, count(*) AS n, CAST(sum(label) AS BIGINT) AS n_positive,
       count(*) FILTER (WHERE split = 'train') AS n_train, count(*) FILTER (WHERE split = 'test') AS n_test FROM lab""")
def s05_json_record(t):
    """One-row JSON record (label summary) written as text and read back."""
    from ..operators import features as P
    spark = t.spark
    rec = P.label_summary(labelled(t)).select("threshold", "n", "n_positive", "n_train", "n_test")
    path = files.write_json_record(rec, files.artefact_dir(spark, "record"))
    return files.read_json_record(spark, path)
