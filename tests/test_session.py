"""The shared folder and the tails of distributions."""
import math
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tillroll.functions.tails import binomial_two_sided_half, chi_square_tail
from tillroll.operators.evaluate import roc_auc
from tillroll.session import checkpoint_dir


def test_cluster_without_shared_folder_raises():
    conf = SimpleNamespace(get=lambda key, default=None: default)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="spark://host:7077")
    with pytest.raises(ValueError):
        checkpoint_dir(SimpleNamespace(sparkContext=sc))


def p(spark, column):
    return spark.range(1).select(column.alias("p")).first()["p"]


@pytest.mark.parametrize("b,c", [(0, 0), (1, 0), (3, 9), (20, 20), (100, 140)])
def test_exact_binomial(spark, b, c):
    n, k = b + c, min(b, c)
    want = min(1.0, 2 * sum(math.comb(n, i) for i in range(k + 1)) / 2 ** n) if n else 1.0
    assert math.isclose(p(spark, binomial_two_sided_half(F.lit(b), F.lit(c))), want, rel_tol=1e-9)


def test_large_counts_need_no_list(spark):
    assert 0 < p(spark, binomial_two_sided_half(F.lit(10 ** 8), F.lit(10 ** 8 + 5_000))) < 1


def test_chi_square_with_four_degrees(spark):
    assert math.isclose(p(spark, chi_square_tail(F.lit(5.0), F.lit(4))), math.exp(-2.5) * (1 + 2.5), rel_tol=1e-12)


def test_auc_of_no_rows(spark):
    df = spark.createDataFrame([], "label int, score double")
    assert [r["roc_auc"] for r in roc_auc(df).collect()] == [None]
