import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillroll.functions.quantiles import quantiles


@pytest.mark.parametrize("max_bracket", [50, 200_000])
def test_grouped_quantiles_match_pandas(spark, max_bracket):
    rng = np.random.default_rng(7)
    n = 20_000
    pdf = pd.DataFrame({"g": rng.integers(0, 3, n),
                        "x": np.round(rng.lognormal(3, 1, n), 2)})
    pdf.loc[pdf.g == 2, "x"] = 5.0          # one group made entirely of ties
    pdf.loc[:10, "x"] = np.nan              # nulls are ignored
    df = spark.createDataFrame(pdf)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = quantiles(df, "x", probs, by=["g"], max_bracket=max_bracket).toPandas().set_index("g").sort_index()
    want = pdf.dropna().groupby("g").x.quantile(probs).unstack()
    np.testing.assert_allclose(got.to_numpy(), want.to_numpy(), rtol=0, atol=1e-9)


def test_global_quantile_refines_in_rounds(spark):
    # 200k rows with max_bracket 100 -> several histogram rounds before the final sort
    df = spark.range(200_000).select(((F.col("id") * 7919) % 100_003 / 3.0).alias("x"))
    got = quantiles(df, "x", [0.5, 0.9], max_bracket=100).first()
    want = df.toPandas().x.quantile([0.5, 0.9]).to_list()
    assert abs(got["q0"] - want[0]) < 1e-9 and abs(got["q1"] - want[1]) < 1e-9


def test_empty_input_gives_no_rows(spark):
    df = spark.createDataFrame([(1, None)], "g int, x double")
    assert quantiles(df, "x", [0.5], by=["g"]).count() == 0


def test_heavy_tail_and_ties_converge(spark):
    rng = np.random.default_rng(11)
    x = np.concatenate([np.round(rng.lognormal(2, 2, 30_000), 3), np.full(30_000, 7.0)])
    df = spark.createDataFrame(pd.DataFrame({"x": x}))
    probs = [0.01, 0.3, 0.5, 0.77, 0.999]
    got = quantiles(df, "x", probs, max_bracket=10).first()
    want = pd.Series(x).quantile(probs).to_list()
    for i, w in enumerate(want):
        assert abs(got[f"q{i}"] - w) < 1e-9


def test_a_gap_at_the_rank_ends(spark):
    # the two ranks of the median lie at the ends of the range: each has a bracket of its own
    df = spark.range(4000).select(F.when(F.col("id") % 2 == 0, -1e9 - F.col("id") / 7.0).otherwise(1e9 + F.col("id") / 3.0).alias("x"))
    got = quantiles(df, "x", [0.5], max_bracket=10).first()["q0"]
    assert got == pytest.approx(df.toPandas().x.quantile(0.5))


def test_rows_are_not_shuffled_by_group(spark):
    df = spark.range(1000).select((F.col("id") % 4).alias("g"), F.col("id").cast("double").alias("x"))
    plan = quantiles(df, "x", [0.5], by=["g"])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"BroadcastHashJoin \[g#\d+L?\], ", plan) and not re.search(r"SortMergeJoin \[g#\d+L?\], ", plan)
