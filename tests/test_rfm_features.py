import datetime as dt

from pyspark.sql import functions as F

from tillroll.operators import features as P
from tillroll.operators import rfm as R

T0 = dt.datetime(2020, 1, 10, 12, 0, 0)


def lines(spark, rows):
    from decimal import Decimal
    rows = [(a, b, c, d, Decimal(str(e)), f) for a, b, c, d, e, f in rows]
    return spark.createDataFrame(rows, "customer_id long, invoice long, invoice_ts timestamp_ntz, "
                                       "quantity int, amount decimal(18,2), stock_code long")


def test_recency_counts_whole_days(spark):
    rows = [(1, 1, T0, 1, 10, 1),                                       # latest line: snapshot = T0 + 1 day
            (2, 2, T0 - dt.timedelta(seconds=1), 1, 10, 1),             # 1 day + 1 s before snapshot -> 1
            (3, 3, T0 - dt.timedelta(days=1) + dt.timedelta(seconds=1), 1, 10, 1),  # 2 days - 1 s -> 1
            (4, 4, T0 - dt.timedelta(days=1), 1, 10, 1),                # exactly 2 days -> 2
            (5, 5, T0 - dt.timedelta(days=40), 2, 5, 1), (5, 5, T0 - dt.timedelta(days=40), 1, 7, 2),
            (5, 6, T0 - dt.timedelta(days=50), 1, 1, 1)]
    r = {x.customer_id: x for x in R.rfm(lines(spark, rows)).collect()}
    assert [r[i].recency for i in (1, 2, 3, 4, 5)] == [1, 1, 1, 2, 41]
    assert r[5].frequency == 2 and r[5].monetary == 13.0     # distinct invoices, exact sum


def test_gaps_truncate_and_cross_day_buckets(spark):
    ts = [T0, T0 + dt.timedelta(hours=23), T0 + dt.timedelta(days=1, hours=23), T0 + dt.timedelta(days=41)]
    inv = spark.createDataFrame([(1, t) for t in ts] + [(2, T0)], "customer_id long, inv_ts timestamp_ntz")
    g = {x.customer_id: x for x in P.inter_purchase_gaps(inv).collect()}
    # gaps: 23 h -> 0, 24 h -> 1, 39 d 1 h -> 39
    assert g[1].n_gaps == 3 and g[1].total_days == 40
    assert abs(g[1].ipt_mean - 40 / 3) < 1e-12
    assert 2 not in g   # a single invoice has no gap


def test_features_ignore_future_rows(spark):
    rows = [(1, 1, dt.datetime(2019, 12, 1), 1, 10, 1), (1, 2, dt.datetime(2020, 2, 1), 1, 99, 1),
            (2, 3, dt.datetime(2019, 6, 1), 1, 5, 1)]
    cut = "2020-01-01"
    full = P.rich_features(P.invoice_rollup(lines(spark, rows)), lines(spark, rows), cut)
    obs_rows = [r for r in rows if r[2] < dt.datetime(2020, 1, 1)]
    obs = P.rich_features(P.invoice_rollup(lines(spark, obs_rows)), lines(spark, obs_rows), cut)
    drop = ["future_spend"]
    a = sorted(tuple(r) for r in full.drop(*drop).collect())
    b = sorted(tuple(r) for r in obs.drop(*drop).collect())
    assert a == b
    fut = {r.customer_id: r.future_spend for r in full.collect()}
    assert fut == {1: 99.0, 2: 0.0}


def test_train_median_ignores_test_rows(spark):
    df = spark.createDataFrame([(i, float(i), "train" if i < 10 else "test") for i in range(20)],
                               "customer_id long, future_spend double, split string")
    a = P.label_by_train_median(df).first()["threshold"]
    df2 = df.withColumn("future_spend", F.when(F.col("split") == "test", 1e9).otherwise(F.col("future_spend")))
    b = P.label_by_train_median(df2).first()["threshold"]
    assert a == b == 4.5


def test_gaps_with_equal_timestamps(spark):
    import math
    inv = spark.createDataFrame([(7, T0), (7, T0), (7, T0), (7, T0 + dt.timedelta(days=1, hours=2))],
                                "customer_id long, inv_ts timestamp_ntz")
    g = P.inter_purchase_gaps(inv).first()
    assert (g.n_gaps, g.total_days) == (3, 1)
    assert abs(g.ipt_mean - 1 / 3) < 1e-15 and abs(g.ipt_std - math.sqrt(2 / 9)) < 1e-15
