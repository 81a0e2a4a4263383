"""Edge cases from the test strategy: empty table, one customer / one invoice,
all-zero future, a single cluster, single-row quantiles."""
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tillroll.functions.quantiles import quantiles
from tillroll.operators import clean as C
from tillroll.operators import features as P
from tillroll.operators import rfm as R
from tillroll.operators import validity as K

LINE = "customer_id long, invoice long, invoice_ts timestamp_ntz, quantity int, amount decimal(18,2), stock_code long"


def test_empty_tables(spark):
    empty = spark.createDataFrame([], LINE)
    assert R.rfm(empty).count() == 0
    q = quantiles(empty, "amount", [0.5]).collect()       # global aggregate: one row, NULL
    assert len(q) == 1 and q[0]["q0"] is None
    assert P.rich_features(P.invoice_rollup(empty), empty, "2020-01-01", checkpoint=False).count() == 0
    nulls = {r.column: r.nulls for r in C.null_counts(empty).collect()}
    assert nulls["__total__"] == 0


def test_one_customer_one_invoice(spark):
    rows = [(1, 10, dt.datetime(2019, 5, 1, 8), 2, Decimal("9.99"), 7)]
    lines = spark.createDataFrame(rows, LINE)
    r = R.rfm(lines).first()
    assert (r.recency, r.frequency, r.monetary) == (1, 1, 9.99)
    f = P.rich_features(P.invoice_rollup(lines), lines, "2020-01-01").first()
    assert f.ipt_mean == float(f.tenure) and f.ipt_std == 0.0 and f.std_invoice_value == 0.0
    assert f.future_spend == 0.0 and f.momentum_ratio == 0.0
    assert quantiles(lines, "amount", [0.0, 0.5, 1.0]).first()[:] == (9.99, 9.99, 9.99)


def test_all_zero_future_labels_nobody_positive(spark):
    df = spark.createDataFrame([(i, 0.0, "train" if i % 5 else "test") for i in range(30)],
                               "customer_id long, future_spend double, split string")
    s = P.label_summary(P.label_by_train_median(df)).first()
    assert s.threshold == 0.0 and s.n_positive == 0 and s.majority_baseline == 1.0 and s.zero_target_pct == 100.0


def test_single_cluster_validity(spark):
    pts = spark.createDataFrame([(i, 0, [float(i), float(i % 3)]) for i in range(20)],
                                "id long, cluster int, x array<double>")
    long_ = K.vector_points(pts, "id", "x")
    assert K.silhouette_score_sq(long_).first()["silhouette_sq"] == 0.0
    assert K.calinski_harabasz(long_).first()[0] is None          # undefined for k = 1
    sizes = K.cluster_sizes(pts).first()
    assert sizes.size == 20 and sizes.pct == 100.0 and not sizes.micro


def test_null_keys_dropped_and_counted(spark):
    raw = spark.createDataFrame([(None, "1"), ("5.0", "2"), ("5.0", "2")], "customer_id string, x string")
    assert C.drop_null_keys(raw).count() == 2
    assert C.dedupe(C.drop_null_keys(raw), exclude=()).count() == 1
    assert C.drop_null_keys(raw).select(C.normalise_key("customer_id")).first()[0] == "5"
    assert raw.where(F.col("customer_id").isNull()).count() == 1


def test_dedupe_counts_the_copies(spark):
    raw = spark.createDataFrame([("a", None, "x"), ("a", None, "y"), ("a", 1, "x"), (None, 1, "x")], "k string, v int, _source string")
    got = C.dedupe(C.drop_null_keys(raw, "k"), copies="n").collect()
    assert sorted((r.v or 0, r.n) for r in got) == [(0, 2), (1, 1)]


def test_removed_copies_from_one_read(spark):
    """The extracts are made once for both counts; an empty table gives zeros."""
    from tillroll.plans.cleaning_queries import c02_dedupe
    df = c02_dedupe(spark, "/root/testdata/sf0.001")
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Generate explode") == 1
