"""Property tests for the exact distributed algorithms (few examples: each runs Spark jobs)."""
import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tillroll.functions.quantiles import quantiles
from tillroll.operators import evaluate as E

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(-50, 50)), min_size=1, max_size=400),
       st.lists(st.floats(0, 1), min_size=1, max_size=4), st.sampled_from([1, 7, 100_000]))
def test_quantiles_any_data(spark, rows, probs, max_bracket):
    pdf = pd.DataFrame(rows, columns=["g", "x"]).astype({"x": float})
    got = quantiles(spark.createDataFrame(pdf), "x", probs, by=["g"], max_bracket=max_bracket).toPandas()
    got = got.set_index("g").sort_index()
    want = pdf.groupby("g").x.quantile(probs).unstack()
    np.testing.assert_allclose(got.to_numpy(), want.to_numpy(), atol=1e-9)


@settings(SETTINGS, max_examples=5)
@given(st.lists(st.floats(allow_nan=False, width=64), min_size=1, max_size=60), st.floats(0, 1), st.sampled_from([1, 7]))
def test_quantiles_of_extreme_values(spark, values, p, max_bracket):
    values += [5e-324, -1.7e308, 1.7e308, 0.0, -0.0, 1.0, 1.0 + 2 ** -52]
    got = quantiles(spark.createDataFrame([(v,) for v in values], "x double"), "x", [p], max_bracket=max_bracket).first()["q0"]
    ordered, h = sorted(values), (len(values) - 1) * p
    a, b = ordered[int(h)], ordered[min(int(h) + 1, len(values) - 1)]
    want = a if a == b else a + (h - int(h)) * (b - a)
    assert got == want or (np.isnan(got) and np.isnan(want))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 9)), min_size=2, max_size=300))
def test_auc_any_scores(spark, rows):
    y = np.array([r[0] for r in rows])
    s = np.array([r[1] / 10 for r in rows])
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")
    got = E.roc_auc(df, buckets=4).first()["roc_auc"]
    pos, neg = s[y == 1], s[y == 0]
    if len(pos) == 0 or len(neg) == 0:
        assert got is None
    else:
        want = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
        assert abs(got - want) < 1e-12
