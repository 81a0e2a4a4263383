"""Classification evaluation and model comparison.

Inputs are prediction DataFrames (label, prediction, score, and grouping
columns such as model / fold / split); every metric is an aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import tails
from ..functions.quantiles import BROADCAST_STATE, bucket_of
from ..session import materialize


def confusion_counts(df: DataFrame, label: str = "label", pred: str = "prediction",
                     by: Sequence[str] = ()) -> DataFrame:
    y, p = F.col(label) == 1, F.col(pred) == 1
    return df.groupBy(*by).agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
                               F.count_if(~y & ~p).alias("tn"), F.count_if(y & ~p).alias("fn"))


def metrics(df: DataFrame, label: str = "label", pred: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """P20: accuracy, balanced accuracy, precision, recall, F1 (positive class),
    specificity; 0 where a denominator is 0 (scikit-learn's zero_division)."""
    c = confusion_counts(df, label, pred, by)
    tp, fp, tn, fn = (F.col(x).cast("double") for x in ("tp", "fp", "tn", "fn"))

    def div(a, b):
        return F.when(b == 0, F.lit(0.0)).otherwise(a / b)
    prec, rec, spec = div(tp, tp + fp), div(tp, tp + fn), div(tn, tn + fp)
    return c.select(*by, "tp", "fp", "tn", "fn", (F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")).alias("n"),
                    div(tp + tn, tp + tn + fp + fn).alias("accuracy"),
                    ((rec + spec) / 2).alias("balanced_accuracy"),
                    prec.alias("precision"), rec.alias("recall"), spec.alias("specificity"),
                    div(2 * tp, 2 * tp + fp + fn).alias("f1"))


def class_report(df: DataFrame, label: str = "label", pred: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """P20: precision, recall, F1 and support of each class, and their plain and support-weighted means ('macro avg',
    'weighted avg'); 0 where a denominator is 0.  From the four counts, one aggregate over the predictions."""
    m = confusion_counts(df, label, pred, by)

    def div(a, b):
        return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b)

    def row(name, hit, extra, missed):
        hit, extra, missed = F.col(hit), F.col(extra), F.col(missed)
        return F.struct(F.lit(name).alias("class"), div(hit, hit + extra).alias("precision"), div(hit, hit + missed).alias("recall"),
                        div(2 * hit, 2 * hit + extra + missed).alias("f1"), (hit + missed).alias("support"))
    zero, one = row("0", "tn", "fn", "fp"), row("1", "tp", "fp", "fn")
    measures = ("precision", "recall", "f1")
    n = zero["support"] + one["support"]
    macro = F.struct(F.lit("macro avg").alias("class"), *[((zero[c] + one[c]) / 2).alias(c) for c in measures], n.alias("support"))
    weighted = F.struct(F.lit("weighted avg").alias("class"), *[
        div(zero[c] * zero["support"] + one[c] * one["support"], n).alias(c) for c in measures], n.alias("support"))
    return m.select(*by, F.explode(F.array(zero, one, macro, weighted)).alias("r")).select(*by, "r.*")


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "prediction",
                     by: Sequence[str] = ()) -> DataFrame:
    """All four (actual, predicted) cells, zero-filled."""
    cells = df.sparkSession.createDataFrame([(a, p) for a in (0, 1) for p in (0, 1)], "actual int, predicted int")
    keys = df.select(*by).distinct() if by else None
    grid = keys.crossJoin(F.broadcast(cells)) if keys is not None else cells
    cnt = df.groupBy(*by, F.col(label).cast("int").alias("actual"), F.col(pred).cast("int").alias("predicted")) \
            .agg(F.count(F.lit(1)).alias("count"))
    return grid.join(cnt, [*by, "actual", "predicted"], "left").fillna(0, ["count"])


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = (),
            max_rows: int = 100_000, buckets: int = 1024) -> DataFrame:
    """Exact ROC-AUC with ties (Mann-Whitney): the share of (positive, negative) pairs in the right order.

    The rows become distinct scores with (pos, neg) counts, written once.  A range of scores with more than
    ``max_rows`` of them is cut into ``buckets`` buckets, as the quantiles cut theirs, and those again; pairs
    of different buckets of one range are counted by a running sum over its at most ``buckets`` totals, pairs inside a
    last bucket by one over its at most ``max_rows`` scores.  Every pair is counted at the one level that parts it, so
    no count travels from level to level and no window grows with the data.

    Rows without a label or score (null, NaN) are left out.  A group of one class only has a null AUC; without
    ``by`` there is always one row.
    """
    by = list(by)
    y, x = F.col(label).cast("long"), F.col(score).cast("double")
    group = F.struct(*by) if by else F.struct(F.lit(0))
    rows = materialize(df.where(y.isNotNull() & x.isNotNull() & ~F.isnan(x)).groupBy(group.alias("_g"), x.alias("_x"))
                       .agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg")))
    size = [F.count(F.lit(1)).alias("c"), F.min("_x").alias("_min"), F.max("_x").alias("_max"),
            F.sum("pos").alias("pos"), F.sum("neg").alias("neg")]
    exact = "decimal(19,0)"

    def pairs(neg_below, ties):
        return F.sum(F.col("pos").cast(exact) * (2 * neg_below + ties).cast(exact)).alias("u2")  # twice, ties count one

    def below(df, part, order):
        w = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn("_below", F.coalesce(F.sum("neg").over(w), F.lit(0)))

    keys, sizes = ["_g"], materialize(rows.groupBy("_g").agg(*size))
    parts = [sizes.select("_g", F.lit(0).cast("decimal(38,0)").alias("u2"), F.col("pos").alias("P"), F.col("neg").alias("N"))]

    def add(counted):
        parts.append(counted.select("_g", "u2", F.lit(0).cast("long").alias("P"), F.lit(0).cast("long").alias("N")))
    while True:
        wide = sizes.where(F.col("c") > max_rows).select(*keys, "_min", "_max")
        n_wide = wide.count()
        if n_wide:
            few = F.broadcast(wide) if n_wide <= BROADCAST_STATE else wide
            rows = materialize(rows.join(few, keys, "left"))
        last = rows.where(F.col("_min").isNull()) if n_wide else rows
        add(below(last, keys, "_x").groupBy("_g").agg(pairs(F.col("_below"), F.col("neg"))))
        if not n_wide:
            break
        rows = rows.where(F.col("_min").isNotNull()).select(
            "_g", "_x", "pos", "neg", F.col("_min").alias("_lo"), F.col("_max").alias("_hi")).withColumn("_b", bucket_of(buckets))
        keys = ["_g", "_lo", "_b"]
        sizes = materialize(rows.groupBy(*keys).agg(*size))
        add(below(sizes, ["_g", "_lo"], "_b").groupBy("_g").agg(pairs(F.col("_below"), F.lit(0))))
    total = reduce(DataFrame.unionByName, parts)
    total = total.groupBy("_g") if by else total
    u = total.agg(F.sum("u2").cast("double").alias("u2"), F.sum("P").alias("P"), F.sum("N").alias("N"))
    auc = F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("u2") / (2 * F.col("P").cast("double") * F.col("N")))
    return u.select(*[F.col(f"_g.{c}").alias(c) for c in by], auc.alias("roc_auc"))


def fold_scores(df: DataFrame, fold: str = "fold", by: Sequence[str] = (), label: str = "label",
                pred: str = "prediction") -> DataFrame:
    """Per-fold metrics, then mean and population sd of F1 per group."""
    m = metrics(df, label, pred, [*by, fold])
    return m.groupBy(*by).agg(F.avg("f1").alias("cv_f1_mean"), F.stddev_pop("f1").alias("cv_f1_std"),
                              F.count(F.lit(1)).alias("folds"))


def paired_t(fold_a: DataFrame, fold_b: DataFrame, fold: str = "fold", metric: str = "f1",
             test_ratio: float | None = None) -> DataFrame:
    """P25: paired t over per-fold differences; plain and Nadeau-Bengio
    corrected (variance x (1/k + test/train)); two-sided p-values."""
    d = (fold_a.select(fold, F.col(metric).alias("a")).join(fold_b.select(fold, F.col(metric).alias("b")), fold)
         .select((F.col("a") - F.col("b")).alias("d")))
    s = d.agg(F.avg("d").alias("mean_diff"), F.var_samp("d").alias("var_diff"), F.count(F.lit(1)).alias("k"))
    ratio = F.lit(test_ratio) if test_ratio is not None else 1 / (F.col("k") - 1)
    t_plain = F.when(F.col("var_diff") > 0, F.col("mean_diff") / F.sqrt(F.col("var_diff") / F.col("k")))
    t_corr = F.when(F.col("var_diff") > 0,
                    F.col("mean_diff") / F.sqrt(F.col("var_diff") * (1 / F.col("k") + ratio)))
    return s.select("mean_diff", "var_diff", "k", t_plain.alias("t"), t_corr.alias("t_corrected"),
                    (F.col("k") - 1).alias("dof"))


def with_t_pvalues(t_df: DataFrame) -> DataFrame:
    return t_df.withColumn("p", tails.t_two_sided(F.col("t"), F.col("dof"))) \
               .withColumn("p_corrected", tails.t_two_sided(F.col("t_corrected"), F.col("dof")))


def mcnemar(pa: DataFrame, pb: DataFrame, key: str, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Discordant counts b (A right, B wrong), c (A wrong, B right) and the
    exact two-sided binomial p (1 when b + c = 0)."""
    j = (pa.select(key, F.col(label).alias("y"), F.col(pred).alias("pa"))
         .join(pb.select(key, F.col(pred).alias("pb")), key))
    ca, cb = F.col("pa") == F.col("y"), F.col("pb") == F.col("y")
    s = j.agg(F.count_if(ca & ~cb).alias("b"), F.count_if(~ca & cb).alias("c"))
    return s.withColumn("p_value", tails.binomial_two_sided_half(F.col("b"), F.col("c")))


def spend_bands(df: DataFrame, spend: str, threshold: str, correct: str = "correct") -> DataFrame:
    """Accuracy by actual spend relative to the threshold, empty bands
    omitted, plus an ALL row."""
    x, m = F.col(spend), F.col(threshold)
    band = (F.when(x == 0, F.lit("1 zero"))
            .when((x > 0) & (x < m * 0.5), F.lit("2 below 0.5x"))
            .when((x >= m * 0.5) & (x <= m * 2), F.lit("3 0.5x-2x"))
            .when((x > m * 2) & (x <= m * 10), F.lit("4 2x-10x"))
            .when(x > m * 10, F.lit("5 above 10x")))
    b = df.withColumn("band", band)
    per = b.where(F.col("band").isNotNull()).groupBy("band").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col(correct).cast("double")).alias("accuracy"))
    tot = b.agg(F.lit("ALL").alias("band"), F.count(F.lit(1)).alias("n"),
                F.avg(F.col(correct).cast("double")).alias("accuracy"))
    return per.unionByName(tot)


def chi_square(df: DataFrame, a: str, b: str) -> DataFrame:
    """Chi-square independence of two categoricals: statistic, dof, p.

    Sum over the non-empty cells, chi2 = n * (sum(o^2 / (ra * rb)) - 1), so no cell
    without rows is made.  Rows with a null in either column are left out.
    """
    ct = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count(F.lit(1)).alias("o"))
    ra = ct.groupBy(a).agg(F.sum("o").alias("ra"))
    rb = ct.groupBy(b).agg(F.sum("o").alias("rb"))
    j = ct.join(ra, a).join(rb, b)
    s = j.agg(F.sum("o").alias("_n"), F.sum(F.col("o") * F.col("o") / (F.col("ra").cast("double") * F.col("rb"))).alias("_q"),
              F.countDistinct(a).alias("_na"), F.countDistinct(b).alias("_nb"))
    s = s.select((F.col("_n") * (F.col("_q") - 1)).alias("chi2"), ((F.col("_na") - 1) * (F.col("_nb") - 1)).alias("dof"))
    return s.withColumn("p_value", tails.chi_square_tail(F.col("chi2"), F.col("dof")))
