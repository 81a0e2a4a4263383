import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tillroll.functions.tails import probit
from tillroll.operators import scaling as SC


def test_probit_accuracy(spark):
    p = np.array([1e-7, 0.001, 0.025, 0.5, 0.975, 0.999, 1 - 1e-7])
    want = np.array([-5.199337582, -3.090232306, -1.959963985, 0.0, 1.959963985, 3.090232306, 5.199337582])
    got = spark.createDataFrame([(float(x),) for x in p], "p double").select(probit(F.col("p")).alias("z")).collect()
    assert np.max(np.abs(np.array([r["z"] for r in got]) - want)) < 1e-6


def test_yeo_johnson_recovers_log_lambda(spark):
    # x = exp(z) - 1 with z normal  ->  log1p(x) is normal, i.e. lambda = 0 is the MLE
    rng = np.random.default_rng(5)
    x = np.expm1(rng.normal(2.0, 0.7, 20_000))
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(len(x)), "x": x}))
    out = SC.yeo_johnson(df, ["x"])
    lam = out.first()["x_lambda"]
    assert abs(lam) < 0.05
    m = out.agg(F.avg("x_yj"), F.stddev_pop("x_yj")).first()
    assert abs(m[0]) < 1e-9 and abs(m[1] - 1) < 1e-9


def test_minmax_and_robust_match_pandas(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"a": rng.lognormal(1, 1, 3000), "b": rng.integers(0, 50, 3000).astype(float)})
    df = spark.createDataFrame(pdf)
    mm = SC.minmax(df, ["a", "b"]).toPandas()
    np.testing.assert_allclose(mm.a_mm, (pdf.a - pdf.a.min()) / (pdf.a.max() - pdf.a.min()), atol=1e-12)
    rb = SC.robust(df, ["a"]).toPandas()
    q1, med, q3 = pdf.a.quantile([0.25, 0.5, 0.75])
    np.testing.assert_allclose(rb.a_rb, (pdf.a - med) / (q3 - q1), atol=1e-12)


def test_quantile_normal_is_monotone_and_centred(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"x": rng.exponential(3.0, 5000)})
    out = SC.quantile_normal(spark.createDataFrame(pdf), ["x"]).toPandas().sort_values("x")
    assert out.x_qn.is_monotonic_increasing
    assert abs(out.x_qn.median()) < 0.01
    assert out.x_qn.abs().max() <= 5.2


def test_yeo_johnson_follows_the_best_lambda_beyond_its_first_grid(spark):
    rng = np.random.default_rng(6)
    y = rng.normal(15.0, 3.5, 20_000).clip(0.1)
    df = spark.createDataFrame(pd.DataFrame({"x": (5 * y + 1) ** 0.2 - 1, "flat": 2.0, "z": -np.expm1(rng.normal(2.0, 0.7, 20_000))}))
    out = SC.yeo_johnson(df, ["x", "flat", "z"])
    r = out.first()
    assert abs(r["x_lambda"] - 5) < 0.7
    assert r["flat_lambda"] == 1.0 and r["flat_yj"] == 0.0
    assert abs(r["z_lambda"] - 2) < 0.1        # the mirror image of lambda 0
