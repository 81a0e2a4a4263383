"""Planted signal: the label follows one feature, the rest is noise."""
import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tillroll.functions.hashing import unit_hash
from tillroll.operators import evaluate as E
from tillroll.operators import forests
from tillroll.operators import learn as L
from tillroll.session import in_parallel, materialize

FEATURES = ["recency", "monetary"]


@pytest.fixture(scope="module")
def planted(spark):
    df = spark.range(403).select(F.col("id").alias("customer_id"))
    df = df.withColumn("recency", unit_hash("customer_id", seed="r") * 300) \
        .withColumn("monetary", unit_hash("customer_id", seed="m") * 1000) \
        .withColumn("state", F.concat(F.lit("s"), F.col("customer_id") % 3)) \
        .withColumn("label", (F.col("recency") + 20 * unit_hash("customer_id", seed="n") < 160).cast("int"))
    return materialize(L.with_folds(materialize(df)))


def test_folds_are_exact_within_each_label(spark, planted):
    for label in (0, 1):
        sizes = [r["count"] for r in planted.where(F.col("label") == label).groupBy("fold").count().collect()]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    again = {tuple(r) for r in L.with_folds(planted.drop("fold").repartition(7)).select("customer_id", "fold").collect()}
    assert again == {tuple(r) for r in planted.select("customer_id", "fold").collect()}


def test_scaling_by_population_moments_of_the_training_rows(planted):
    train = planted.where("fold <> 0")
    x = L.preprocessing(train, FEATURES).transform(train)
    m = x.agg(*[f(f"{c}_z").alias(f"{f.__name__}_{c}") for c in FEATURES for f in (F.avg, F.stddev_pop)]).first()
    for c in FEATURES:
        assert m[f"avg_{c}"] == pytest.approx(0, abs=1e-9) and m[f"stddev_pop_{c}"] == pytest.approx(1)


def test_constant_feature_unknown_level_and_no_rows(planted):
    train = planted.withColumn("flat", F.lit(3.0))
    prep = L.preprocessing(train.where("state <> 's2'"), ["recency", "flat"], one_hot="state")
    rows = prep.transform(train).select("state", vector_to_array("features").alias("v")).collect()
    assert all(r["v"][1] == 0 and len(r["v"]) == 4 and sum(r["v"][2:]) == (r["state"] != "s2") for r in rows)
    with pytest.raises(ValueError):
        L.preprocessing(planted.limit(0), FEATURES)


@pytest.mark.parametrize("name", ["logistic_regression", "decision_tree", "random_forest"])
def test_planted_feature_is_learned(planted, name):
    train, test = planted.where("fold <> 0"), planted.where("fold = 0")
    params = {"numTrees": 20, "maxDepth": 5} if name == "random_forest" else L.FIXED[name]
    model = L.fit_with(train, name, params, FEATURES)
    pred = model.transform(test).withColumn("score", vector_to_array("probability")[1])
    assert E.roc_auc(pred).first()[0] > 0.95
    lo, hi = pred.agg(F.min("score"), F.max("score")).first()
    assert 0 <= lo <= hi <= 1
    weights = {r["feature"]: r["importance"]
               for r in L.importances(planted.sparkSession, {name: model}, FEATURES).collect()}
    assert abs(weights["recency"]) > 3 * abs(weights["monetary"])
    if name == "logistic_regression":
        assert weights["recency"] < 0


def test_grid_sizes():
    assert [len(L.grid(n)) for n in L.MODELS] == [5, 70, 64]


def test_tuning_takes_the_best_point_and_errors_come_out(planted):
    points = [{"maxDepth": 1, "minInstancesPerNode": 200}, {"maxDepth": 3}]
    model, best, f1 = L.tune(planted, "decision_tree", FEATURES, points=points)
    assert best == points[1] and len(f1) == 5 and min(f1) > 0.8
    with pytest.raises(Exception):
        L.tune(planted, "decision_tree", FEATURES, points=[{"maxDepth": -1}])


def test_learning_curve_covers_every_fold(planted):
    rows = L.learning_curve(planted, "decision_tree", {"maxDepth": 3}, [0.3, 1.0], FEATURES, k=5)
    assert {(r[0], r[1]) for r in rows} == {(fr, f) for fr in (0.3, 1.0) for f in range(5)}
    assert all(r[3] > 0.7 for r in rows)


def test_learning_curve_subsets_are_exact_and_nested(planted):
    fractions = [0.3, 0.6, 1.0]
    rows = L.curve_steps(planted, fractions).collect()
    assert len(rows) == planted.count()
    for fold in range(5):
        steps = [r.step for r in rows if r.fold == fold]
        assert [sum(s <= i for s in steps) for i in range(3)] == [int((len(steps) - 1) * f) + 1 for f in fractions]


@pytest.mark.parametrize("impurity", ["gini", "entropy"])
def test_a_cut_tree_equals_a_fit_at_that_depth(planted, impurity):
    noisy = planted.withColumn("label", F.when(unit_hash("customer_id", seed="f") < 0.2, 1 - F.col("label")).otherwise(F.col("label")))
    train, valid = noisy.where("fold <> 0"), noisy.where("fold = 0")
    prep = L.preprocessing(train, FEATURES)
    x, y = L.vectors(prep, train, 300), L.vectors(prep, valid, 100)
    params = {"minInstancesPerNode": 2, "impurity": impurity}
    deep = L.classifier("decision_tree", params | {"maxDepth": L.MAX_DEPTH}).fit(x)
    depths = [1, 2, 3, 5, 8, L.MAX_DEPTH]
    counts = forests.nested_counts(deep, y, depths, [1])
    nodes = forests.Forest.of(forests.saved_nodes(deep).toPandas())
    for d in depths:
        own = L.classifier("decision_tree", params | {"maxDepth": d}).fit(x)
        want = own.transform(y).agg(*[F.count_if((F.col("prediction") == p) & (F.col("label") == l)).alias(n)
                                      for n, p, l in (("tp", 1, 1), ("fp", 1, 0), ("fn", 0, 1), ("tn", 0, 0))]).first().asDict()
        assert {k: counts[d, 1][k] for k in want} == want
        leaf = nodes.leaves(d)
        reached = [0]
        for at in reached:  # the cut tree has as many nodes as the fit
            reached += [] if leaf[at] else [int(nodes.left[at]), int(nodes.right[at])]
        assert len(reached) == own.numNodes


def test_first_trees_and_votes_equal_the_forest(planted):
    train, valid = planted.where("fold <> 0"), planted.where("fold = 0")
    prep = L.preprocessing(train, FEATURES)
    x, y = L.vectors(prep, train, 300), L.vectors(prep, valid, 100)
    model = L.classifier("random_forest", {"numTrees": 15, "maxDepth": 6, "featureSubsetStrategy": "1"}).fit(x)
    counts = forests.nested_counts(model, y, [6], [1, 15])
    f1 = E.metrics(model.transform(y)).first()["f1"]
    assert forests.f1(counts[6, 15]) == pytest.approx(f1)
    assert all(sum(v for k, v in c.items() if k in ("tp", "fp", "fn", "tn")) == y.count() for c in counts.values())
    first = E.metrics(model.trees[0].transform(y)).first()["f1"]
    assert forests.f1(counts[6, 1]) == pytest.approx(first)


def test_nested_groups_cover_the_grids():
    for name, fits in (("decision_tree", 10), ("random_forest", 8)):
        groups = forests.nested_groups(L.grid(name))
        assert len(groups) == fits and sorted(i for _, g in groups for i in g) == list(range(len(L.grid(name))))


def test_nested_search_equals_separate_fits(planted):
    points = [{"maxDepth": d, "minInstancesPerNode": m} for d in (1, 3, 30) for m in (1, 20)]
    with L.fold_frames(planted, FEATURES) as folds:
        got = L.cross_validate(folds, "decision_tree", points)
        for p, scores in list(zip(points, got))[:3]:
            model = L.classifier("decision_tree", p).fit(folds[0].train)
            assert scores[0] == pytest.approx(E.metrics(model.transform(folds[0].valid)).first()["f1"])


def test_parallel_jobs_keep_their_own_properties(spark):
    def job(i):
        return spark.range(1000).selectExpr(f"sum(id + {i}) AS s").first()["s"]
    assert in_parallel(spark, job, range(40)) == [499500 + 1000 * i for i in range(40)]


def test_strategies_that_try_as_many_features_share_a_fit(spark):
    points = L.grid("random_forest")
    groups = forests.nested_groups(points, 5)  # the root and the half of 5 are both 3
    assert len(groups) == 4 and sorted(i for _, g in groups for i in g) == list(range(len(points)))
    assert len(forests.nested_groups(points, 16)) == 8
    rows = spark.range(300).select(F.array(*[unit_hash("id", seed=f"x{i}") for i in range(5)]).alias("x"), (F.col("id") % 2).cast("int").alias("label"))
    df = rows.select("label", array_to_vector("x").alias("features")).coalesce(1).cache()
    a, b = (L.classifier("random_forest", {"numTrees": 4, "maxDepth": 6, "featureSubsetStrategy": s}).fit(df) for s in ("sqrt", "0.5"))
    text = lambda m: m.toDebugString.split("\n", 1)[1]
    assert text(a) == text(b)


def test_forest_in_parts(spark, planted, monkeypatch):
    train, test = planted.where("fold > 0"), planted.where("fold = 0")
    params = {"numTrees": 11, "maxDepth": 4}
    whole = L.fit_with(train, "random_forest", params, FEATURES)
    assert not isinstance(whole.stages[-1], L.ForestParts)
    monkeypatch.setattr(L, "FOREST_PART", 700)
    model = L.fit_with(train, "random_forest", params, FEATURES)
    parts = model.stages[-1].parts
    assert len(parts) > 1 and sum(m.getNumTrees for m in parts) == 11
    assert len({m.toDebugString.split("\n", 1)[1] for m in parts}) == len(parts)
    assert abs(sum(model.stages[-1].featureImportances) - 1) < 1e-9
    for r in model.transform(test).select("probability", "prediction", "features").collect():
        votes = sum(m.predictRaw(r.features).toArray() for m in parts)
        assert np.allclose(r.probability.toArray(), votes / 11) and r.prediction == votes.argmax()
    assert L.importances(spark, {"random_forest": model}, FEATURES).count() == len(FEATURES)


def test_trees_held_at_a_time():
    at = lambda n, least: L.trees_at_once("decision_tree", {"minInstancesPerNode": least}, n, 8)
    assert [at(1000, 1), at(576_000, 1), at(576_000, 5), at(10 ** 8, 1)] == [8, 2, 8, 1]


def test_folds_of_trees_in_few_partitions(spark, planted, monkeypatch):
    monkeypatch.setattr(L, "ROWS_PER_PARTITION", 10)
    with L.fold_frames(planted, FEATURES) as folds:
        assert all(f.train.rdd.getNumPartitions() == 1 for f in folds)


def test_boosted_trees_equal_mllibs(planted):
    noisy = planted.withColumn("label", F.when(unit_hash("customer_id", seed="f") < 0.2, 1 - F.col("label")).otherwise(F.col("label")))
    params = {"maxIter": 6, "maxDepth": 3, "minInstancesPerNode": 5}
    prep = L.preprocessing(noisy, FEATURES)
    tables = [L.vectors(prep, noisy.where(f"fold <> {i}"), 300) for i in (0, 1)]
    sizes = [x.count() for x in tables]
    y = L.vectors(prep, noisy, 403)
    for x, n, model in zip(tables, sizes, L.fit_boosted(tables, sizes, params)):
        own = L.classifier("gradient_boosting", params, n).fit(x)
        assert [int((t.left >= 0).sum()) * 2 + 1 for t in model.trees] == [t.numNodes for t in own.trees]
        p = lambda m: [tuple(r) for r in m.transform(y).select(vector_to_array("probability")[1], "prediction").collect()]
        assert np.allclose(p(model), p(own), atol=1e-12)


def test_boosting_passes_do_not_grow_with_tables_or_partitions(spark, planted):
    def passes(tables):
        group = f"boost-{len(tables)}-{tables[0].rdd.getNumPartitions()}"
        sizes = [x.count() for x in tables]
        spark.sparkContext.setJobGroup(group, group)
        L.fit_boosted(tables, sizes, {"maxIter": 2, "maxDepth": 2})
        tracker = spark.sparkContext.statusTracker()
        jobs = tracker.getJobIdsForGroup(group)
        stages = [s for j in jobs for s in tracker.getJobInfo(j).stageIds]
        return len(jobs), max(tracker.getStageInfo(s).numTasks for s in stages if tracker.getStageInfo(s))
    prep = L.preprocessing(planted, FEATURES)
    x = L.vectors(prep, planted, 403)
    many = prep.transform(planted).select("label", "features").repartition(6).cache()
    one, four, cut = passes([x]), passes([x] * 4), passes([many])
    assert four[0] - one[0] <= 3    # the thresholds of a table are one job, its trees none
    assert cut[0] == one[0] and cut[1] <= 6


def test_cross_validation_of_boosting_equals_separate_fits(planted):
    params = {"maxIter": 3, "maxDepth": 2}
    with L.fold_frames(planted, FEATURES) as folds:
        got, = L.cross_validate(folds, "gradient_boosting", [params])
        for f, score in list(zip(folds, got))[:2]:
            model = L.classifier("gradient_boosting", params, f.n).fit(f.train)
            assert score == pytest.approx(E.metrics(model.transform(f.valid)).first()["f1"])
