"""Feature scalings for the clustering audit.

min-max and robust scaling are one-row aggregates broadcast back.  The
Yeo-Johnson lambda is a maximum-likelihood fit done as aggregates: a coarse
lambda grid, then a fine grid around the best point, each evaluated for all
grid points in one pass (rows x grid values are generated map-side and
reduced by partial aggregation before any shuffle).  The quantile-to-normal
map interpolates a bounded reference-quantile table and applies the probit as
a Column expression.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.quantiles import quantiles
from ..functions.tails import probit


def minmax(df: DataFrame, cols: Sequence[str], suffix: str = "_mm") -> DataFrame:
    st = df.agg(*[F.min(F.col(c).cast("double")).alias(f"_{c}_lo") for c in cols],
                *[F.max(F.col(c).cast("double")).alias(f"_{c}_hi") for c in cols])
    out = df.crossJoin(F.broadcast(st))
    for c in cols:
        rng = F.col(f"_{c}_hi") - F.col(f"_{c}_lo")
        out = out.withColumn(c + suffix, F.when(rng == 0, F.lit(0.0))
                             .otherwise((F.col(c).cast("double") - F.col(f"_{c}_lo")) / rng))
    return out.drop(*[f"_{c}_{s}" for c in cols for s in ("lo", "hi")])


def robust(df: DataFrame, cols: Sequence[str], suffix: str = "_rb") -> DataFrame:
    """(x - median) / (q75 - q25); a zero IQR scales by 1."""
    out = df
    for c in cols:
        q = quantiles(df, c, [0.25, 0.5, 0.75], names=[f"_{c}_q1", f"_{c}_med", f"_{c}_q3"])
        out = out.crossJoin(F.broadcast(q))
        iqr = F.col(f"_{c}_q3") - F.col(f"_{c}_q1")
        out = out.withColumn(c + suffix, (F.col(c).cast("double") - F.col(f"_{c}_med"))
                             / F.when(iqr == 0, F.lit(1.0)).otherwise(iqr)).drop(f"_{c}_q1", f"_{c}_med", f"_{c}_q3")
    return out


def yeo_johnson_expr(x: Column, lam: Column) -> Column:
    pos = F.when(F.abs(lam) < 1e-12, F.log1p(x)).otherwise((F.pow(x + 1, lam) - 1) / lam)
    neg = F.when(F.abs(lam - 2) < 1e-12, -F.log1p(-x)).otherwise(-(F.pow(1 - x, 2 - lam) - 1) / (2 - lam))
    return F.when(x >= 0, pos).otherwise(neg)


def _best_lambda(df: DataFrame, c: str, grid: list[float]) -> DataFrame:
    """One row (lam) maximising -n/2 log var(y_lam) + (lam - 1) sum sign(x) log1p|x|."""
    x = F.col(c).cast("double")
    g = df.select(x.alias("_x")).where(F.col("_x").isNotNull()).select(
        "_x", F.explode(F.array(*[F.lit(v) for v in grid])).alias("lam"))
    ll = (g.groupBy("lam").agg(F.var_pop(yeo_johnson_expr(F.col("_x"), F.col("lam"))).alias("v"),
                               F.sum(F.signum("_x") * F.log1p(F.abs("_x"))).alias("s"),
                               F.count(F.lit(1)).alias("n"))
          .withColumn("llf", -F.col("n") / 2 * F.log(F.col("v")) + (F.col("lam") - 1) * F.col("s")))
    return ll.where((F.col("v") > 0) & (F.col("v") < float("inf"))).agg(F.max_by("lam", "llf").alias("lam"))


def yeo_johnson(df: DataFrame, cols: Sequence[str], suffix: str = "_yj",
                lo: float = -3.0, hi: float = 3.0) -> DataFrame:
    """Per column: MLE lambda (coarse 0.05 grid, then 0.0005 around it),
    transform, then z-score with the population sd.  The grid starts on [lo, hi] and is moved on while its best point
    lies on its edge, to where the likelihood falls or the powers leave the doubles.  A column without variance keeps
    lambda 1 and becomes 0."""
    out = df
    steps = int(round((hi - lo) / 0.05))
    varies = df.agg(*[F.coalesce(F.min(c) < F.max(c), F.lit(False)).alias(c) for c in cols]).first()
    for c in cols:
        if not varies[c]:
            out = out.withColumn(c + suffix, F.when(F.col(c).isNotNull(), F.lit(0.0))).withColumn(c + "_lambda", F.lit(1.0))
            continue
        lam0, start = None, lo
        while True:
            grid = [round(start + i * 0.05, 6) for i in range(steps + 1)]
            best = _best_lambda(df, c, grid).first()["lam"]
            if best is None or best == lam0:
                break
            lam0 = best
            if lam0 not in (grid[0], grid[-1]):
                break
            start = lam0 - (hi - lo) if lam0 == grid[0] else lam0
        fine = [round(lam0 - 0.05 + i * 0.0005, 6) for i in range(201)]
        lam = float(_best_lambda(df, c, fine).first()["lam"])
        y = yeo_johnson_expr(F.col(c).cast("double"), F.lit(lam))
        t = out.withColumn(c + suffix, y)
        mom = t.agg(F.avg(c + suffix).alias("_mu"), F.stddev_pop(c + suffix).alias("_sd"))
        out = (t.crossJoin(F.broadcast(mom))
               .withColumn(c + suffix, (F.col(c + suffix) - F.col("_mu")) / F.col("_sd"))
               .withColumn(c + "_lambda", F.lit(lam)).drop("_mu", "_sd"))
    return out


def quantile_normal(df: DataFrame, cols: Sequence[str], n_quantiles: int = 1000, suffix: str = "_qn",
                    clip: float = 1e-7, accuracy: int = 100_000) -> DataFrame:
    """x -> its interpolated rank in a table of ``n_quantiles`` reference
    quantiles -> probit, clipped to [clip, 1 - clip] (bounded table, broadcast)."""
    out = df
    probs = [i / (n_quantiles - 1) for i in range(n_quantiles)]
    for c in cols:
        qv = df.agg(F.percentile_approx(F.col(c).cast("double"), probs, accuracy).alias("q")).first()["q"]
        # distinct knots with the mean reference probability of repeated values
        knots: dict[float, list[float]] = {}
        for v, p in zip(qv, probs):
            knots.setdefault(float(v), []).append(p)
        xs = sorted(knots)
        ps = [float(np.mean(knots[v])) for v in xs]
        if len(xs) == 1:
            out = out.withColumn(c + suffix, F.lit(0.0))
            continue
        splits = [-float("inf")] + xs[1:-1] + [float("inf")]
        b = Bucketizer(splits=splits, inputCol=c + "_d", outputCol=c + "_b", handleInvalid="keep")
        t = b.transform(out.withColumn(c + "_d", F.col(c).cast("double")))
        xa, pa = F.array(*[F.lit(v) for v in xs]), F.array(*[F.lit(v) for v in ps])
        i = F.col(c + "_b").cast("int")
        x0, x1 = F.element_at(xa, i + 1), F.element_at(xa, i + 2)
        p0, p1 = F.element_at(pa, i + 1), F.element_at(pa, i + 2)
        xd = F.col(c + "_d")
        u = (F.when(xd <= F.lit(xs[0]), F.lit(ps[0])).when(xd >= F.lit(xs[-1]), F.lit(ps[-1]))
             .otherwise(p0 + (xd - x0) * (p1 - p0) / (x1 - x0)))
        u = F.least(F.greatest(u, F.lit(clip)), F.lit(1 - clip))
        out = t.withColumn(c + suffix, probit(u)).drop(c + "_d", c + "_b")
    return out
