"""Leakage-safe temporal features.

Windows are defined by one cutoff: ``ts < cutoff`` is observed, ``ts >=
cutoff`` is the future.  Every feature is a conditional aggregate over the
invoice roll-up keyed by customer, so the observed features and the future
target come out of one shuffle, with no join and no second scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import safe_div
from ..functions.quantiles import median, quantiles


def _cut(cutoff: str) -> Column:
    return F.lit(cutoff).cast("timestamp_ntz")


def days(a, b) -> Column:
    """Whole elapsed 24 h periods from a to b (truncated)."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.timestamp_diff("DAY", a, b)


# --- P01 / P02 / P03 --------------------------------------------------------

def temporal_split(df: DataFrame, cutoff: str, ts_col: str = "invoice_ts") -> tuple[DataFrame, DataFrame]:
    """(observation, future) as two filters over one plan."""
    return df.where(F.col(ts_col) < _cut(cutoff)), df.where(F.col(ts_col) >= _cut(cutoff))


def split_windows(df: DataFrame, cutoff: str, ts_col: str = "invoice_ts") -> DataFrame:
    """P01 report: per window rows, customers, first/last timestamp."""
    w = F.when(F.col(ts_col) < _cut(cutoff), F.lit("observation")).otherwise(F.lit("future"))
    return df.where(F.col(ts_col).isNotNull()).groupBy(w.alias("window")).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("customer_id").alias("customers"),
        F.date_format(F.min(ts_col), "yyyy-MM-dd HH:mm:ss").alias("first_ts"),
        F.date_format(F.max(ts_col), "yyyy-MM-dd HH:mm:ss").alias("last_ts"))


def split_integrity(df: DataFrame, cutoff: str, ts_col: str = "invoice_ts") -> DataFrame:
    """No overlap, exhaustive partition, window lengths in whole days."""
    obs = F.col(ts_col) < _cut(cutoff)
    fut = F.col(ts_col) >= _cut(cutoff)
    a = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(obs).alias("n_obs"), F.count_if(fut).alias("n_future"),
               F.max(F.when(obs, F.col(ts_col))).alias("_omax"), F.min(F.when(obs, F.col(ts_col))).alias("_omin"),
               F.max(F.when(fut, F.col(ts_col))).alias("_fmax"), F.min(F.when(fut, F.col(ts_col))).alias("_fmin"))
    return a.select("n_rows", "n_obs", "n_future",
                    (F.col("_omax") < F.col("_fmin")).alias("no_overlap"),
                    (F.col("n_obs") + F.col("n_future") == F.col("n_rows")).alias("exhaustive"),
                    days("_omin", "_omax").alias("obs_days"), days("_fmin", "_fmax").alias("future_days"))


def cold_start(df: DataFrame, cutoff: str, ts_col: str = "invoice_ts") -> DataFrame:
    """Customers seen only in the future window, and their share of future customers."""
    per = df.groupBy("customer_id").agg(F.count_if(F.col(ts_col) < _cut(cutoff)).alias("_o"),
                                        F.count_if(F.col(ts_col) >= _cut(cutoff)).alias("_f"))
    return per.agg(F.count_if(F.col("_o") > 0).alias("obs_customers"),
                   F.count_if(F.col("_f") > 0).alias("future_customers"),
                   F.count_if((F.col("_o") == 0) & (F.col("_f") > 0)).alias("cold_start")) \
        .withColumn("cold_start_pct", F.col("cold_start") * 100.0 / F.col("future_customers"))


# --- P10: invoice roll-up ---------------------------------------------------

def invoice_rollup(lines: DataFrame) -> DataFrame:
    """P10: one row per (customer, invoice): value, date (earliest line), items, lines."""
    return lines.groupBy("customer_id", "invoice").agg(
        F.min("invoice_ts").alias("inv_ts"), F.sum("amount").alias("inv_value"),
        F.sum("quantity").cast("bigint").alias("inv_items"), F.count(F.lit(1)).alias("n_lines"))


# --- P04 / P05: base features and target in one pass -----------------------

def base_features(inv: DataFrame, cutoff: str) -> DataFrame:
    """P04 + P05 from an invoice roll-up: customers with >= 1 observed invoice.

    recency, frequency, monetary, tenure (days cutoff - first invoice),
    avg_order_value = monetary / frequency, future_spend (0 when absent).
    """
    c = _cut(cutoff)
    obs = F.col("inv_ts") < c
    g = inv.groupBy("customer_id").agg(
        F.max(F.when(obs, F.col("inv_ts"))).alias("_last"),
        F.min(F.when(obs, F.col("inv_ts"))).alias("_first"),
        F.count_if(obs).alias("frequency"),
        F.sum(F.when(obs, F.col("inv_value"))).alias("_m"),
        F.sum(F.when(~obs, F.col("inv_value"))).alias("_fut"))
    return g.where(F.col("frequency") > 0).select(
        "customer_id",
        days("_last", c).alias("recency"),
        "frequency",
        F.col("_m").cast("double").alias("monetary"),
        days("_first", c).alias("tenure"),
        (F.col("_m").cast("double") / F.col("frequency")).alias("avg_order_value"),
        F.coalesce(F.col("_fut").cast("double"), F.lit(0.0)).alias("future_spend"))


# --- P11-P15: richer behaviour ----------------------------------------------

def inter_purchase_gaps(inv: DataFrame) -> DataFrame:
    """Whole-day gaps between consecutive invoices: count, total, mean, population sd.

    Invoices sharing a timestamp only add zero gaps, so they are first
    collapsed to (customer, timestamp, multiplicity) by a partial aggregate.
    Consecutive distinct timestamps are then paired inside (customer, day)
    buckets, and the pair crossing a bucket boundary comes from the small
    per-bucket (first, last) table - a hot customer is never sorted in one
    task.  Mean and sd come from exact integer sums (sum g, sum g^2, n).
    """
    from pyspark.sql import Window
    ts = inv.groupBy("customer_id", "inv_ts").agg(F.count(F.lit(1)).alias("_dup"))
    x = ts.withColumn("_bucket", F.date_trunc("DAY", "inv_ts"))
    w_in = Window.partitionBy("customer_id", "_bucket").orderBy("inv_ts")
    inner = (x.withColumn("_prev", F.lag("inv_ts").over(w_in)).where(F.col("_prev").isNotNull())
             .select("customer_id", days("_prev", "inv_ts").alias("gap")))
    edges = x.groupBy("customer_id", "_bucket").agg(F.min("inv_ts").alias("_first"), F.max("inv_ts").alias("_last"))
    w_b = Window.partitionBy("customer_id").orderBy("_bucket")
    cross = (edges.withColumn("_prev_last", F.lag("_last").over(w_b)).where(F.col("_prev_last").isNotNull())
             .select("customer_id", days("_prev_last", "_first").alias("gap")))
    pos = inner.unionByName(cross).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("_n1"), F.sum("gap").alias("_s1"),
        F.sum(F.col("gap") * F.col("gap")).alias("_s2"))
    zeros = ts.where(F.col("_dup") > 1).groupBy("customer_id").agg(F.sum(F.col("_dup") - 1).alias("_n0"))
    g = (pos.join(zeros, "customer_id", "full_outer")
         .select("customer_id", F.coalesce("_n1", F.lit(0)).alias("_n1"), F.coalesce("_n0", F.lit(0)).alias("_n0"),
                 F.coalesce("_s1", F.lit(0)).alias("_s1"), F.coalesce("_s2", F.lit(0)).alias("_s2")))
    n = F.col("_n1") + F.col("_n0")
    s1, s2 = F.col("_s1").cast("decimal(38,0)"), F.col("_s2").cast("decimal(38,0)")
    nd = n.cast("decimal(38,0)")
    var = (s2 * nd - s1 * s1).cast("double") / (n.cast("double") * n.cast("double"))
    return g.select("customer_id", n.alias("n_gaps"), F.col("_s1").alias("total_days"),
                    (F.col("_s1").cast("double") / n).alias("ipt_mean"),
                    F.sqrt(F.greatest(var, F.lit(0.0))).alias("ipt_std"))


def invoice_stats(inv: DataFrame) -> DataFrame:
    """Max invoice value, sample sd of invoice value (0 for one invoice), mean items."""
    return inv.groupBy("customer_id").agg(
        F.max("inv_value").cast("double").alias("max_invoice_value"),
        F.coalesce(F.stddev_samp(F.col("inv_value").cast("double")), F.lit(0.0)).alias("std_invoice_value"),
        F.avg(F.col("inv_items").cast("double")).alias("avg_items_per_invoice"))


def product_breadth(lines: DataFrame) -> DataFrame:
    """Distinct products and total quantity per customer."""
    return lines.groupBy("customer_id").agg(F.countDistinct("stock_code").alias("distinct_products"),
                                            F.sum("quantity").cast("bigint").alias("total_quantity"))


def rich_features(inv: DataFrame, lines: DataFrame, cutoff: str, recent_days: int = 90,
                  checkpoint: bool = True) -> DataFrame:
    """Base features + gaps, invoice stats, breadth, active months,
    last-``recent_days`` spend, momentum and purchase rate; observed rows only.

    The invoice roll-up feeds four aggregates (base, stats, in-bucket and
    cross-bucket gaps); with ``checkpoint`` it is materialised once (one row
    per invoice) so the line table is scanned twice in total - once for the
    roll-up, once for product breadth - instead of once per aggregate.
    """
    if checkpoint:
        from ..session import materialize
        inv = materialize(inv)
    c = _cut(cutoff)
    o_inv = inv.where(F.col("inv_ts") < c)
    base = base_features(inv, cutoff)
    recent = c - F.expr(f"INTERVAL {int(recent_days)} DAYS")
    agg = o_inv.groupBy("customer_id").agg(
        F.max("inv_value").cast("double").alias("max_invoice_value"),
        F.coalesce(F.stddev_samp(F.col("inv_value").cast("double")), F.lit(0.0)).alias("std_invoice_value"),
        F.avg(F.col("inv_items").cast("double")).alias("avg_items_per_invoice"),
        F.countDistinct(F.date_trunc("MONTH", "inv_ts")).alias("active_months"),
        F.coalesce(F.sum(F.when(F.col("inv_ts") >= recent, F.col("inv_value"))).cast("double"),
                   F.lit(0.0)).alias("spend_last90"))
    gaps = inter_purchase_gaps(o_inv)
    breadth = product_breadth(lines.where(F.col("invoice_ts") < c))
    f = (base.join(agg, "customer_id", "left").join(gaps, "customer_id", "left")
         .join(breadth, "customer_id", "left"))
    return f.select(
        "customer_id", "recency", "frequency", "monetary", "avg_order_value", "tenure",
        F.coalesce("ipt_mean", F.col("tenure").cast("double")).alias("ipt_mean"),
        F.coalesce("ipt_std", F.lit(0.0)).alias("ipt_std"),
        "max_invoice_value", "std_invoice_value", "avg_items_per_invoice",
        "distinct_products", "total_quantity", "active_months", "spend_last90",
        F.coalesce(safe_div(F.col("spend_last90"), F.col("monetary")), F.lit(0.0)).alias("momentum_ratio"),
        F.coalesce(safe_div(F.col("frequency").cast("double"), F.col("tenure").cast("double")),
                   F.lit(0.0)).alias("purchase_rate"),
        "future_spend")


# --- P06 / P07 / P08 / P09 --------------------------------------------------

def stratified_split(features: DataFrame, test_fraction: float = 0.2, seed: int = 42,
                     key: str = "customer_id", target: str = "future_spend") -> DataFrame:
    """``split`` = 'test' / 'train', exact in each of the two strata (target over its median, or not).

    The customers with the smallest hashes of a stratum are held out: those up to the
    exact ``test_fraction`` quantile of the hash, which are ceil(test_fraction * n) of n
    (equal hashes fall on the same side).  No window spans a stratum, and a customer lands on the same
    side in every run.  ``features`` is read three times: pass a materialised table.
    """
    from ..functions.hashing import unit_hash
    median = quantiles(features, target, [0.5], names=["_median"])
    drawn = features.crossJoin(F.broadcast(median)) \
        .withColumn("_stratum", F.coalesce((F.col(target) > F.col("_median")).cast("int"), F.lit(0))) \
        .withColumn("_u", unit_hash(F.col(key), seed=f"split{seed}"))
    cuts = quantiles(drawn, "_u", [test_fraction], by=["_stratum"], names=["_cut"])  # at most two rows
    return drawn.join(F.broadcast(cuts), "_stratum") \
        .withColumn("split", F.when(F.col("_u") <= F.col("_cut"), F.lit("test")).otherwise(F.lit("train"))) \
        .select(*features.columns, "split")


def label_by_train_median(split_df: DataFrame, target: str = "future_spend",
                          label: str = "label") -> DataFrame:
    """threshold = median of the target over *train* rows; label = target > threshold."""
    m = median(split_df.where(F.col("split") == "train"), target, name="threshold")
    return split_df.crossJoin(F.broadcast(m)).withColumn(
        label, (F.col(target) > F.col("threshold")).cast("int"))


def label_summary(labelled: DataFrame, target: str = "future_spend", label: str = "label") -> DataFrame:
    """P07 report: threshold, class balance, zero-target %, majority baseline."""
    a = labelled.agg(F.first("threshold").alias("threshold"), F.count(F.lit(1)).alias("n"),
                     F.sum(label).alias("n_positive"),
                     F.count_if(F.col(target) == 0).alias("n_zero_target"),
                     F.count_if(F.col("split") == "train").alias("n_train"),
                     F.count_if(F.col("split") == "test").alias("n_test"))
    pos = F.col("n_positive") / F.col("n")
    return a.select("threshold", "n", "n_positive", "n_train", "n_test",
                    (F.col("n_zero_target") * 100.0 / F.col("n")).alias("zero_target_pct"),
                    F.greatest(pos, 1 - pos).alias("majority_baseline"))


def threshold_leakage(split_df: DataFrame, target: str = "future_spend") -> DataFrame:
    """All-rows median vs train-only median and how many labels flip."""
    m_all = median(split_df, target, name="median_all")
    m_tr = median(split_df.where(F.col("split") == "train"), target, name="median_train")
    j = split_df.crossJoin(F.broadcast(m_all)).crossJoin(F.broadcast(m_tr))
    return j.agg(F.first("median_all").alias("median_all"), F.first("median_train").alias("median_train"),
                 F.count_if((F.col(target) > F.col("median_all")) != (F.col(target) > F.col("median_train")))
                 .alias("labels_flipped"), F.count(F.lit(1)).alias("n"))


def leak_check(inv: DataFrame, cutoff: str) -> DataFrame:
    """Features rebuilt from hard-filtered observed rows equal the
    conditional-aggregate ones; recency and every feature non-negative."""
    c = _cut(cutoff)
    a = base_features(inv, cutoff)
    hard = inv.where(F.col("inv_ts") < c).groupBy("customer_id").agg(
        days(F.max("inv_ts"), c).alias("r2"), F.count(F.lit(1)).alias("f2"),
        F.sum("inv_value").cast("double").alias("m2"), days(F.min("inv_ts"), c).alias("t2"))
    j = a.join(hard, "customer_id", "full_outer")
    same = (F.col("recency").eqNullSafe(F.col("r2")) & F.col("frequency").eqNullSafe(F.col("f2"))
            & F.col("monetary").eqNullSafe(F.col("m2")) & F.col("tenure").eqNullSafe(F.col("t2"))
            & F.col("avg_order_value").eqNullSafe(F.col("m2") / F.col("f2")))
    neg = ((F.col("recency") < 0) | (F.col("frequency") < 0) | (F.col("monetary") < 0)
           | (F.col("tenure") < 0) | (F.col("avg_order_value") < 0) | (F.col("future_spend") < 0))
    return j.agg(F.count(F.lit(1)).alias("customers"), F.count_if(~same).alias("mismatched"),
                 F.count_if(F.col("recency") < 0).alias("negative_recency"),
                 F.count_if(neg).alias("negative_any"),
                 F.min("recency").alias("min_recency"), F.max("recency").alias("max_recency"))
