"""Trees grown inside the tasks: equal to MLlib's on rows whose thresholds are not drawn; forests and searches on planted rows."""
import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tillroll.functions.hashing import unit_hash
from tillroll.operators import evaluate as E
from tillroll.operators import forests, growing
from tillroll.operators import learn as L
from tillroll.session import materialize

FEATURES = ["recency", "monetary", "frequency"]


@pytest.fixture(scope="module")
def noisy(spark):
    df = spark.range(1203).select(F.col("id").alias("customer_id"))
    df = df.withColumn("recency", F.floor(unit_hash("customer_id", seed="r") * 90)) \
        .withColumn("monetary", unit_hash("customer_id", seed="m") * 1000) \
        .withColumn("frequency", F.floor(unit_hash("customer_id", seed="q") * 9)) \
        .withColumn("label", (F.col("recency") + F.col("monetary") / 20 < 70).cast("int"))
    df = df.withColumn("label", F.when(unit_hash("customer_id", seed="f") < 0.15, 1 - F.col("label")).otherwise(F.col("label")))
    return materialize(L.with_folds(materialize(df)))


@pytest.fixture(scope="module")
def halves(noisy):
    train, test = noisy.where("fold <> 0"), noisy.where("fold = 0")
    prep = L.preprocessing(train, FEATURES)
    n = train.count()
    return L.vectors(prep, train, n), L.vectors(prep, test, 300), n


def probabilities(model, df):
    return [r[0] for r in model.transform(df).select(vector_to_array("probability")[1]).collect()]


@pytest.mark.parametrize("impurity,least,large", [("gini", 1, 512), ("gini", 5, 8), ("entropy", 1, 8), ("entropy", 20, 512)])
def test_a_grown_tree_equals_mllibs(halves, monkeypatch, impurity, least, large):
    monkeypatch.setattr(growing, "LARGE", large)
    x, y, n = halves
    params = {"maxDepth": 30, "minInstancesPerNode": least, "impurity": impurity}
    want = L.classifier("decision_tree", params, n).fit(x)
    got = growing.fit(x, n, growing.Spec(1, 30, least, impurity, 3, False, 42), 3)
    assert got.nodes == want.numNodes
    assert np.allclose(probabilities(got, y), probabilities(want, y), atol=1e-12)
    assert np.allclose(got.featureImportances, want.featureImportances.toArray())


def test_a_search_on_many_rows_fits_no_model_and_scores_the_same(noisy, monkeypatch):
    points = [{"maxDepth": d, "minInstancesPerNode": m, "impurity": i} for d in (1, 4, 30) for m in (1, 20) for i in ("gini", "entropy")]
    with L.fold_frames(noisy, FEATURES) as folds:
        want = L.cross_validate(folds, "decision_tree", points)
        monkeypatch.setattr(L, "GROWN_ROWS", 0)
        monkeypatch.setattr(L, "classifier", None)
        assert np.allclose(L.cross_validate(folds, "decision_tree", points), want)
        points = [{"numTrees": m, "maxDepth": d, "featureSubsetStrategy": s} for m in (4, 9) for d in (3, 30) for s in ("sqrt", "0.5")]
        one = L.cross_validate(folds, "random_forest", points)
        monkeypatch.setattr(growing, "TASK_CELLS", 2000)  # a forest is dealt over several tasks
        assert np.allclose(L.cross_validate(folds, "random_forest", points), one)
    assert min(np.mean(scores) for scores in one) > 0.7


def test_counts_of_a_grown_forest_are_those_of_the_fitted_one(halves, monkeypatch):
    monkeypatch.setattr(L, "GROWN_ROWS", 0)
    x, y, n = halves
    spec = L.grown_spec(x, n, "random_forest", {"numTrees": 12, "maxDepth": 6}, depths=[2, 6], sizes=[5, 12])
    counts, = growing.counts([(x, y)], [n], [(0, spec)], 3)
    model = growing.fit(x, n, spec, 3)
    assert forests.f1(counts[6, 12]) == pytest.approx(E.metrics(model.transform(y)).first()["f1"])
    assert all(sum(c.values()) == y.count() for c in counts.values())
    sent = probabilities(model, y)
    monkeypatch.setattr(growing, "SENT_NODES", 0)  # blocks of rows and trees meet in pairs
    rows = y.withColumn("id", F.monotonically_increasing_id())
    met = dict(model.transform(rows).select("id", vector_to_array("probability")[1]).collect())
    assert np.allclose([met[i] for i in sorted(met)], sent)


def test_small_and_too_large_tables_are_left_to_mllib(halves, monkeypatch):
    x, _, n = halves
    assert L.grown_spec(x, n, "random_forest", {}) is None
    assert L.grown_spec(x, 5_000, "random_forest", {"numTrees": 400}).tried == 2
    assert L.grown_spec(x, 10 ** 8, "decision_tree", {}) is None
    assert L.grown_spec(x, 10 ** 6, "logistic_regression", {}) is None


def test_one_class_and_missing_rows(spark, halves):
    x, y, n = halves
    one = x.where("label = 1")
    model = growing.fit(one, one.count(), growing.Spec(3, 5, 1, "gini", 2, True, 1), 3)
    assert set(probabilities(model, y)) == {1.0}
    counts, = growing.counts([(x, y.limit(0))], [n], [(0, growing.Spec(1, 5, 1, "gini", 3, False, 1, (5,), (1,)))], 3)
    assert sum(counts[5, 1].values()) == 0
