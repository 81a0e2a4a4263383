import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.functions import tails
from tillroll.operators import evaluate as E


def brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return float(np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg]))


def test_auc_with_ties_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 600)
    s = np.round(rng.random(600) * 0.5 + y * 0.3, 2)   # many ties
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")
    got = E.roc_auc(df, buckets=16).first()["roc_auc"]
    assert abs(got - brute_auc(y, s)) < 1e-12


def test_auc_of_scores_cut_again_and_again(spark):
    rng = np.random.default_rng(2)
    rows, want = [], {}
    for name, s in (("spread", 10.0 ** rng.integers(-300, 300, 200) * rng.choice([-1, 1], 200)),
                    ("near", 0.5 + 1e-15 * rng.integers(0, 40, 300)), (None, np.round(rng.random(100), 1))):
        y = rng.integers(0, 2, len(s))
        want[name] = brute_auc(y, s)
        rows += [(name, int(a), float(b)) for a, b in zip(y, s)]
    rows += [("near", 1, None), ("near", 0, float("nan")), ("near", None, 0.1), ("one class", 1, float("inf"))]
    df = spark.createDataFrame(rows, "model string, label int, score double")
    got = {r.model: r.roc_auc for r in E.roc_auc(df, by=["model"], max_rows=3, buckets=4).collect()}
    assert got.pop("one class") is None and got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_metrics_and_confusion(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0), (0, 1)], "label int, prediction int")
    m = E.metrics(df).first()
    assert (m.tp, m.fp, m.tn, m.fn) == (1, 1, 2, 1)
    assert m.accuracy == 0.6 and m.precision == 0.5 and m.recall == 0.5
    cm = {(r.actual, r.predicted): r["count"] for r in E.confusion_matrix(df).collect()}
    assert cm == {(0, 0): 2, (0, 1): 1, (1, 0): 1, (1, 1): 1}


def test_mcnemar_edge_cases(spark):
    a = spark.createDataFrame([(i, 1, 1) for i in range(5)], "k int, label int, prediction int")
    r = E.mcnemar(a, a, "k").first()
    assert (r.b, r.c, r.p_value) == (0, 0, 1.0)


@pytest.mark.parametrize("t,dof,p", [(2.0, 4, 0.11611652351681556), (0.5, 10, 0.6278936057)])
def test_t_tail(spark, t, dof, p):
    assert abs(value(spark, tails.t_two_sided(F.lit(t), F.lit(dof))) - p) < 1e-6


def test_binomial_and_chi2_tails(spark):
    assert abs(value(spark, tails.binomial_two_sided_half(F.lit(3), F.lit(10))) - 0.09228515625) < 1e-12
    assert abs(value(spark, tails.chi_square_tail(F.lit(12.75), F.lit(15))) - 0.622) < 2e-3


def test_tails_against_closed_forms(spark):
    def even_t(t, dof):
        theta, coefficient, total = math.atan(abs(t) / math.sqrt(dof)), 1.0, 0.0
        for j in range(dof // 2):
            total += coefficient * math.cos(theta) ** (2 * j)
            coefficient *= (2 * j + 1) / (2 * j + 2)
        return 1 - math.sin(theta) * total

    def even_chi(x, dof):
        return sum(math.exp(-x / 2 + j * math.log(x / 2) - math.lgamma(j + 1)) for j in range(dof // 2))
    ts = [(t, d) for t in (0.0, 0.01, 0.7, 2.5, 9.0) for d in (2, 4, 10, 48, 1000)]
    chis = [(x, d) for x in (0.02, 1.5, 24.0, 90.0, 1003.0) for d in (2, 4, 24, 100, 1000)]
    rows = spark.createDataFrame([(float(a), int(b)) for a, b in ts + chis], "x double, dof int")
    got = rows.select("x", "dof", tails.t_two_sided(F.col("x"), F.col("dof")).alias("t"),
                      tails.chi_square_tail(F.col("x"), F.col("dof")).alias("c")).collect()
    for r, (x, d) in zip(got, ts + chis):
        if (x, d) in ts:
            assert r["t"] == pytest.approx(even_t(x, d), abs=1e-12)
        else:
            assert r["c"] == pytest.approx(even_chi(x, d), rel=1e-9, abs=1e-14)
    assert value(spark, tails.t_two_sided(F.lit(1.0), F.lit(1))) == pytest.approx(0.5)
    assert value(spark, tails.t_two_sided(F.lit(None).cast("double"), F.lit(3))) is None
    assert value(spark, tails.chi_square_tail(F.lit(1.0), F.lit(0))) is None


def test_log_gamma(spark):
    xs = [1e-6, 0.5, 1.0, 2.0, 3.7, 9.99, 10.0, 55.5, 1e4, 1e9]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select(tails.log_gamma(F.col("x")).alias("g")).collect()
    assert [r["g"] for r in got] == pytest.approx([math.lgamma(x) for x in xs], rel=1e-13, abs=1e-13)


def test_fraction_without_end_raises(spark, monkeypatch):
    monkeypatch.setattr(tails, "TERMS", 2)
    monkeypatch.setattr(tails, "TERMS_PER_ROOT", 0)
    with pytest.raises(Exception, match="did not converge"):
        value(spark, tails.t_two_sided(F.lit(2.0), F.lit(31)))


def test_class_report_by_hand(spark):
    rows = [(1, 1)] * 3 + [(1, 0)] * 1 + [(0, 1)] * 2 + [(0, 0)] * 4
    got = {r["class"]: r for r in E.class_report(spark.createDataFrame(rows, "label int, prediction int")).collect()}
    assert (got["1"]["precision"], got["1"]["recall"], got["1"]["support"]) == (3 / 5, 3 / 4, 4)
    assert (got["0"]["precision"], got["0"]["recall"], got["0"]["support"]) == (4 / 5, 4 / 6, 6)
    assert abs(got["weighted avg"]["recall"] - 0.7) < 1e-12 and got["macro avg"]["support"] == 10
    assert abs(got["macro avg"]["precision"] - 0.7) < 1e-12
    none = {r["class"]: r for r in E.class_report(spark.createDataFrame([(0, 0)], "label int, prediction int")).collect()}
    assert none["1"]["f1"] == 0.0 and none["1"]["support"] == 0
