"""Serving queries over the saved customer, prediction and model tables (Q01-Q14).

Each is a DataFrame function with optional filters; population numbers
(totals for shares, the overall mean) are one-row aggregates broadcast back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash_hex
from ..functions.numeric import round_half_up

# ---------------------------------------------------------------------------
# Short segment names, their display order and the plain
# names of the model features, as shown by the source project's dashboard.
# ---------------------------------------------------------------------------
SEGMENT_SHORT_NAMES = {
    "Champions (recent, frequent, high spend)": "Champions",
    "At-Risk High Value (lapsing loyal spender)": "At-Risk High Value",
    "New / Promising (recent, low frequency & value)": "New & Promising",
    "Lost / Dormant Low-Value": "Lost / Dormant",
}
SEGMENT_ORDER = ["Champions", "At-Risk High Value", "New & Promising", "Lost / Dormant"]
FRIENDLY_FEATURES = {
    "monetary": "How much they have spent before",
    "recency": "Time since their last purchase",
    "frequency": "Number of orders placed",
    "tenure": "How long they have been a customer",
    "avg_order_value": "Average value per order",
}


def _map_expr(mapping: dict, col: str):
    m = None
    for k, v in mapping.items():
        cond = F.col(col) == F.lit(k)
        m = F.when(cond, F.lit(v)) if m is None else m.when(cond, F.lit(v))
    return m


def order_key(seg_col: str = "segment"):
    o = None
    for i, s in enumerate(SEGMENT_ORDER):
        cond = F.col(seg_col) == F.lit(s)
        o = F.when(cond, F.lit(i)) if o is None else o.when(cond, F.lit(i))
    return o.otherwise(F.lit(len(SEGMENT_ORDER)))


def short_names(customers: DataFrame, mapping: dict = SEGMENT_SHORT_NAMES, label: str = "segment_label") -> DataFrame:
    """Q01: add ``segment``; an unmapped label fails the query (no silent drop)."""
    seg = _map_expr(mapping, label)
    return customers.withColumn(
        "segment", F.when(seg.isNull(), F.raise_error(F.concat(F.lit("unmapped segment label: "),
                                                               F.coalesce(F.col(label), F.lit("NULL")))))
        .otherwise(seg))


def filter_view(customers: DataFrame, segments: Sequence[str] | None = None,
                states: Sequence[str] | None = None) -> DataFrame:
    """Q02: empty selection = no filter."""
    v = customers
    if segments:
        v = v.where(F.col("segment").isin(list(segments)))
    if states:
        v = v.where(F.col("state").isin(list(states)))
    return v


def kpis(view: DataFrame, all_customers: DataFrame) -> DataFrame:
    """Q03: customers, revenue, mean value, segments in view, share of all revenue."""
    a = view.agg(F.count(F.lit(1)).alias("customers"), exact_money_sum("monetary").alias("revenue"),
                 F.countDistinct("segment").alias("segments")).withColumn(
        "avg_value", F.col("revenue") / F.col("customers"))
    tot = all_customers.agg(exact_money_sum("monetary").alias("_all"))
    return a.crossJoin(F.broadcast(tot)).select("customers", "revenue", "avg_value", "segments",
                                                (F.col("revenue") * 100 / F.col("_all")).alias("revenue_share_pct"))


def segment_totals(customers: DataFrame) -> DataFrame:
    """Q04: per segment customers, revenue, average value, % customers, % revenue, display order."""
    g = customers.groupBy("segment").agg(F.count(F.lit(1)).alias("customers"), exact_money_sum("monetary").alias("revenue"))
    g = g.withColumn("avg_value", F.col("revenue") / F.col("customers"))
    tot = g.agg(F.sum("customers").alias("_c"), F.sum("revenue").alias("_r"))
    return (g.crossJoin(F.broadcast(tot))
            .select("segment", "customers", "revenue", "avg_value",
                    (F.col("customers") * 100.0 / F.col("_c")).alias("pct_customers"),
                    (F.col("revenue") * 100 / F.col("_r")).alias("pct_revenue"),
                    order_key().alias("display_order")))


def exact_money_sum(col: str):
    """Sum of a 2-dp money column in DECIMAL (order-independent), as DOUBLE."""
    return F.sum(F.col(col).cast("decimal(18,2)")).cast("double")


def headline(all_customers: DataFrame) -> DataFrame:
    """Q05: insight rows on the unfiltered base (Champions share; At-Risk revenue)."""
    t = segment_totals(all_customers)
    return t.where(F.col("segment").isin("Champions", "At-Risk High Value")).select(
        "segment", "customers", "revenue", "pct_customers", "pct_revenue")


def state_stats(customers: DataFrame) -> DataFrame:
    """Q06: per state n, mean, sample sd and the 95 % half-width 1.96 sd / sqrt(n) (0 when undefined)."""
    g = customers.groupBy("state").agg(F.count(F.lit(1)).alias("customers"), F.avg("monetary").alias("mean"),
                                       F.stddev_samp("monetary").alias("sd"))
    return g.withColumn("ci", F.coalesce(1.96 * F.col("sd") / F.sqrt("customers"), F.lit(0.0)))


def states_covering_mean(customers: DataFrame) -> DataFrame:
    """Q07: how many state intervals contain the overall mean."""
    s = state_stats(customers)
    m = customers.agg(F.avg("monetary").alias("overall"))
    return s.crossJoin(F.broadcast(m)).agg(
        F.count_if((F.col("mean") - F.col("ci") <= F.col("overall")) & (F.col("mean") + F.col("ci") >= F.col("overall")))
        .alias("covering"), F.count(F.lit(1)).alias("states"), F.first("overall").alias("overall_mean"))


def segment_means(customers: DataFrame) -> DataFrame:
    """Q08: mean recency, frequency, monetary per segment."""
    return customers.groupBy("segment").agg(F.avg("recency").alias("recency"), F.avg("frequency").alias("frequency"),
                                            F.avg("monetary").alias("monetary"))


def context_sample(customers: DataFrame, n: int = 2500, seed: int = 42, key: str = "customer_id") -> DataFrame:
    """Q09: a repeatable sample of min(n, rows): the n smallest md5(key|seed).
    (A top-n is the feature here; Spark plans it as a per-partition top-n.)"""
    return customers.withColumn("_h", hash_hex(F.col(key), seed=seed)).orderBy("_h").limit(n).drop("_h")


def contact_list(predictions: DataFrame, customers: DataFrame, min_prob: float = 0.5,
                 segments: Sequence[str] | None = None, states: Sequence[str] | None = None,
                 held_out_only: bool = False) -> DataFrame:
    """Q10: scored customers with segment/state, filtered, most likely first, label decoded."""
    j = predictions.join(customers.select("customer_id", "segment", "state"), "customer_id", "left")
    v = j.where(F.col("probability") >= min_prob)
    if segments:
        v = v.where(F.col("segment").isin(list(segments)))
    if states:
        v = v.where(F.col("state").isin(list(states)))
    if held_out_only:
        v = v.where(F.col("data_split") == "held-out test")
    return v.select("customer_id", "segment", "state", F.col("probability").alias("confidence"),
                    F.when(F.col("predicted") == 1, F.lit("High spender")).otherwise(F.lit("Low / no spend"))
                    .alias("prediction"), "actual_future_spend", "data_split", "correct") \
        .orderBy(F.desc("confidence"), "customer_id")


def contact_metrics(lst: DataFrame) -> DataFrame:
    """Q11: list size, mean confidence, accuracy on the list, training rows inside."""
    return lst.agg(F.count(F.lit(1)).alias("customers"), F.avg("confidence").alias("avg_confidence"),
                   F.avg(F.col("correct").cast("double")).alias("accuracy"),
                   F.count_if(F.col("data_split") == "train").alias("train_rows"))


def driver_table(importance: DataFrame, model: str, friendly: dict = FRIENDLY_FEATURES) -> DataFrame:
    """Q12: a model's features with plain names and whether each raises or lowers the prediction."""
    names = _map_expr(friendly, "feature")
    return (importance.where(F.col("model") == model)
            .select("feature", F.coalesce(names, F.col("feature")).alias("label"), "importance",
                    F.when(F.col("importance") > 0, F.lit("Raises")).otherwise(F.lit("Lowers")).alias("direction"))
            .orderBy("importance"))


def comparison_long(comparison: DataFrame, metrics: Sequence[str] = ("accuracy", "precision", "recall", "f1")) -> DataFrame:
    """Q13: wide model comparison -> (model, metric, value)."""
    return comparison.unpivot("model", list(metrics), "metric", "value")


def money(col, decimals: int = 0):
    """'RM 1,234' with half-up rounding done in IEEE arithmetic first."""
    return F.concat(F.lit("RM "), F.format_number(round_half_up(col, decimals), decimals))


def briefing(totals: DataFrame, comparison: DataFrame, all_customers: DataFrame, silhouette: DataFrame) -> DataFrame:
    """Q14: text lines (section, ord, line): one per segment, one per model, totals and validity."""
    seg = totals.select(F.lit("segments").alias("section"), F.col("display_order").alias("ord"), F.concat(
        F.lit("- "), F.col("segment"), F.lit(": "), F.format_number(F.col("customers"), 0), F.lit(" customers ("),
        F.format_number(round_half_up("pct_customers", 1), 1), F.lit("% of base), "),
        F.format_number(round_half_up("pct_revenue", 1), 1), F.lit("% of revenue, average value "),
        money(F.col("avg_value")), F.lit(".")).alias("line"))
    mod = comparison.select(F.lit("models").alias("section"), F.lit(0).alias("ord"), F.concat(
        F.lit("- "), F.col("model"), F.lit(": accuracy "), F.format_number(round_half_up("accuracy", 3), 3),
        F.lit(", F1 "), F.format_number(round_half_up("f1", 3), 3), F.lit(", ROC-AUC "),
        F.format_number(round_half_up("roc_auc", 3), 3), F.lit(", train-test gap "),
        F.format_number(round_half_up("overfit_gap", 4), 4)).alias("line"))
    tot = all_customers.agg(F.count(F.lit(1)).alias("n"), exact_money_sum("monetary").alias("rev")).select(
        F.lit("totals").alias("section"), F.lit(0).alias("ord"),
        F.concat(F.lit("TOTALS: "), F.format_number(F.col("n"), 0), F.lit(" customers, "), money(F.col("rev")),
                 F.lit(" total revenue.")).alias("line"))
    val = silhouette.select(F.lit("validity").alias("section"), F.lit(0).alias("ord"), F.concat(
        F.lit("CLUSTER VALIDITY: silhouette (squared) "), F.format_number(round_half_up("silhouette_sq", 3), 3),
        F.lit(".")).alias("line"))
    return seg.unionByName(mod).unionByName(tot).unionByName(val)
