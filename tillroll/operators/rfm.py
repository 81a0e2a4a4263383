"""RFM segmentation.

Everything is keyed by customer and computed from the invoice roll-up, so the
only wide shuffle is one row per invoice into one row per customer; all
population-level numbers (snapshot, medians, totals) are one-row aggregates
joined back by broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import exact_mean, round_half_up
from ..functions.quantiles import quantiles
from ..session import materialize
from .features import invoice_rollup

RFM = ["recency", "frequency", "monetary"]


def snapshot(df: DataFrame, ts_col: str = "invoice_ts") -> DataFrame:
    """One row, ``snapshot_ts`` = latest timestamp + 1 day."""
    return df.agg((F.max(ts_col) + F.expr("INTERVAL 1 DAY")).alias("snapshot_ts"))


def rfm_from_invoices(inv: DataFrame, snap: DataFrame | None = None,
                      states: DataFrame | None = None) -> DataFrame:
    """R02 on an invoice roll-up (customer_id, invoice, inv_ts, inv_value).

    recency   = whole 24 h periods from the customer's last invoice to the snapshot
    frequency = distinct invoices (one roll-up row each)
    monetary  = exact sum of line amounts
    """
    per = inv.groupBy("customer_id").agg(
        F.max("inv_ts").alias("_last"),
        F.count(F.lit(1)).alias("frequency"),
        F.sum("inv_value").alias("_m"))
    if snap is None:
        # The snapshot is a global aggregate, so it needs a second pass.  Make
        # that pass read the per-customer table (one row per customer,
        # checkpointed) rather than rescan and reshuffle the line table.
        per = materialize(per)
        snap = snapshot(per, "_last")
    out = (per.crossJoin(F.broadcast(snap))  # one-row aggregate
           .select("customer_id",
                   F.expr("timestampdiff(DAY, _last, snapshot_ts)").alias("recency"),
                   "frequency",
                   F.col("_m").cast("double").alias("monetary")))
    if states is not None:
        out = out.join(states, "customer_id", "left")
    return out


def rfm(lines: DataFrame) -> DataFrame:
    """R02 on canonical lines; carries ``state`` (1:1 per customer -> min) if present."""
    inv = invoice_rollup(lines)
    out = rfm_from_invoices(inv, snapshot(lines))
    if "state" in lines.columns:
        st = lines.groupBy("customer_id").agg(F.min("state").alias("state"))
        out = out.join(st, "customer_id", "left")
    return out


def rfm_summary(rfm_df: DataFrame) -> DataFrame:
    """Per feature: count, mean, sample sd, min, quartiles, max, and the
    population skewness of the raw and the log1p feature."""
    parts = []
    for f in RFM:
        q = quantiles(rfm_df, f, [0.25, 0.5, 0.75], names=["p25", "p50", "p75"])
        a = rfm_df.agg(
            F.count(f).alias("count"), F.avg(F.col(f).cast("double")).alias("mean"),
            F.stddev_samp(F.col(f).cast("double")).alias("std"),
            F.min(F.col(f).cast("double")).alias("min"), F.max(F.col(f).cast("double")).alias("max"),
            F.skewness(F.col(f).cast("double")).alias("skew_raw"),
            F.skewness(F.log1p(F.col(f).cast("double"))).alias("skew_log1p"))
        parts.append(a.crossJoin(F.broadcast(q)).select(F.lit(f).alias("feature"), "*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def rfm_scaled(rfm_df: DataFrame, cols=RFM) -> DataFrame:
    """log1p, then z-score with the *population* sd (one-row moments)."""
    logged = rfm_df.select("*", *[F.log1p(F.col(c).cast("double")).alias(f"{c}_log") for c in cols])
    mom = logged.agg(*[F.avg(f"{c}_log").alias(f"{c}_mu") for c in cols],
                     *[F.stddev_pop(f"{c}_log").alias(f"{c}_sd") for c in cols])
    return (logged.crossJoin(F.broadcast(mom))
            .select(*rfm_df.columns,
                    *[((F.col(f"{c}_log") - F.col(f"{c}_mu")) / F.col(f"{c}_sd")).alias(f"{c}_z")
                      for c in cols]))


def rule_clusters(rfm_df: DataFrame, medians: DataFrame | None = None) -> DataFrame:
    """A fixed, rule-based 4-way partition used where a clustering must be
    reproducible in SQL: 2 x (recency <= median) + (monetary >= median)."""
    med = medians if medians is not None else population_medians(rfm_df)
    med = med.select(F.col("pop_recency_median").alias("_r_med"), F.col("pop_monetary_median").alias("_m_med"))
    return (rfm_df.crossJoin(F.broadcast(med))
            .withColumn("cluster", (F.when(F.col("recency") <= F.col("_r_med"), 2).otherwise(0)
                                    + F.when(F.col("monetary") >= F.col("_m_med"), 1).otherwise(0)))
            .drop("_r_med", "_m_med"))


def segment_profile(clustered: DataFrame, cluster_col: str = "cluster") -> DataFrame:
    """Per cluster count, mean R/F/M, median M, share of customers; 1 dp."""
    med = quantiles(clustered, "monetary", [0.5], by=[cluster_col], names=["_m_median"])
    g = clustered.groupBy(cluster_col).agg(
        F.count(F.lit(1)).alias("count"),
        exact_mean("recency").alias("_r"), exact_mean("frequency").alias("_f"),
        F.avg("monetary").alias("_m"))
    tot = clustered.agg(F.count(F.lit(1)).alias("_total"))
    return (g.join(med, cluster_col, "left").crossJoin(F.broadcast(tot))
            .select(F.col(cluster_col).alias("cluster"), "count",
                    round_half_up("_r", 1).alias("recency_mean"),
                    round_half_up("_f", 1).alias("frequency_mean"),
                    round_half_up("_m", 1).alias("monetary_mean"),
                    round_half_up("_m_median", 1).alias("monetary_median"),
                    round_half_up(F.col("count") * 100.0 / F.col("_total"), 1).alias("pct_of_customers")))


# The eight segment names, by (recent, frequent, high value).
SEGMENT_LABELS = {
    (True, True, True): "Champions (recent, frequent, high spend)",
    (True, False, True): "Big Spenders (recent, high value, infrequent)",
    (True, True, False): "Loyal Regulars (recent, frequent, modest spend)",
    (True, False, False): "New / Promising (recent, low frequency & value)",
    (False, True, True): "At-Risk High Value (lapsing loyal spender)",
    (False, False, True): "At-Risk Big Spender (lapsing, was high value)",
    (False, True, False): "Lapsing Regulars (was frequent, modest value)",
    (False, False, False): "Lost / Dormant Low-Value",
}


def population_medians(rfm_df: DataFrame) -> DataFrame:
    """One row: median recency, frequency, monetary over all customers."""
    return quantiles(rfm_df.select(*[F.col(c).cast("double").alias(c) for c in RFM])
                     .select(F.explode(F.array(*[F.struct(F.lit(c).alias("f"), F.col(c).alias("v"))
                                                 for c in RFM])).alias("s"))
                     .select("s.f", "s.v"), "v", [0.5], by=["f"], names=["med"]) \
        .agg(*[F.max(F.when(F.col("f") == c, F.col("med"))).alias(f"pop_{c}_median") for c in RFM])


def rule_labels(profile: DataFrame, rfm_df: DataFrame, medians: DataFrame | None = None) -> DataFrame:
    """Label each cluster from its (1-dp) means against the population
    medians on three flags: recent (<=), frequent (>=), high value (>=)."""
    med = medians if medians is not None else population_medians(rfm_df)
    p = profile.crossJoin(F.broadcast(med))  # one row
    recent = F.col("recency_mean") <= F.col("pop_recency_median")
    frequent = F.col("frequency_mean") >= F.col("pop_frequency_median")
    high = F.col("monetary_mean") >= F.col("pop_monetary_median")
    label = None
    for (r, f, h), name in SEGMENT_LABELS.items():
        cond = (recent if r else ~recent) & (frequent if f else ~frequent) & (high if h else ~high)
        label = F.when(cond, F.lit(name)) if label is None else label.when(cond, F.lit(name))
    return p.withColumn("segment_label", label)


def disambiguate_labels(labelled: DataFrame) -> DataFrame:
    """Clusters sharing a label get ' [rank r]' appended, r = average
    rank of monetary_mean (descending) truncated to int.  The input has one
    row per cluster (k rows), so these windows are tiny."""
    by_label = Window.partitionBy("segment_label")
    by_m = Window.orderBy(F.desc("monetary_mean"))
    tie = Window.partitionBy("monetary_mean")
    avg_rank = (F.rank().over(by_m) + (F.count(F.lit(1)).over(tie) - 1) / 2.0).cast("int")
    return labelled.withColumn("_dups", F.count(F.lit(1)).over(by_label)).withColumn(
        "segment_label",
        F.when(F.col("_dups") > 1, F.concat("segment_label", F.lit(" [rank "), avg_rank.cast("string"),
                                             F.lit("]"))).otherwise(F.col("segment_label"))).drop("_dups")


def label_segments(profile: DataFrame, rfm_df: DataFrame, medians: DataFrame | None = None) -> DataFrame:
    """R06 + R07 on a profile from :func:`segment_profile`."""
    cols = profile.columns
    return disambiguate_labels(rule_labels(profile, rfm_df, medians)).select(*cols, "segment_label")


def assign_labels(clustered: DataFrame, labelled_profile: DataFrame,
                  cluster_col: str = "cluster") -> DataFrame:
    """Cluster -> label onto every customer (profile is k rows: broadcast)."""
    lk = labelled_profile.select(F.col("cluster").alias(cluster_col), "segment_label")
    return clustered.join(F.broadcast(lk), cluster_col, "left")
