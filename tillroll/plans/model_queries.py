"""P17-P19, P24 (tuned), P29-P31, P33-P37: MLlib model work (rows-only checks where a model decides).

Tuning is the expensive step, so the tuned models of one table directory are
fitted once per Spark application and shared by the queries below; only the
models, the fold scores and two checkpointed tables are kept.
"""

from __future__ import annotations

import json
import threading
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import r6
from ..functions.quantiles import quantiles
from ..operators import evaluate as E
from ..operators import features as P
from ..operators import learn as L
from ..session import in_parallel, materialize
from ..sources import retail
from . import sqltext as S
from .feature_queries import CUTOFF, FEATURES, features, labelled
from .registry import query

_LOCK = threading.Lock()
_FRAMES: dict = {}
_TUNED: dict = {}


def _union(parts):
    return reduce(DataFrame.unionByName, parts)


def _frames(t):
    """(all modelled customers with their state, training rows with folds), each computed once."""
    key = (t.spark.sparkContext.applicationId, t.root)
    if key not in _FRAMES:
        df = materialize(labelled(t).join(retail.customer_states(t), "customer_id", "left"))
        _FRAMES[key] = df, materialize(L.with_folds(df.where(F.col("split") == "train")))
    return _FRAMES[key]


def _tuned(t, name):
    """(pipeline refitted with the best point, that point, F1 in each fold) of one family."""
    key = (t.spark.sparkContext.applicationId, t.root, name)
    with _LOCK:
        if key not in _TUNED:
            _TUNED[key] = L.tune(_frames(t)[1], name)
        return _TUNED[key]


def bundle(t):
    df, train = _frames(t)
    return {"df": df, "train": train, "tuned": {name: _tuned(t, name) for name in L.MODELS}}


def _best_name(b):
    """Model with the best held-out F1 (the one that is scored and recommended)."""
    test = b["df"].where(F.col("split") == "test")
    f1 = {name: E.metrics(model.transform(test)).first()["f1"] for name, (model, _, _) in b["tuned"].items()}
    return max(f1, key=f1.get)


def _fold_scores(spark, scores):
    return spark.createDataFrame(list(enumerate(scores)), "fold int, f1 double")


_Z = ", ".join(f"{S.r6(f'(ln(1 + {c}) - m_{c}) / s_{c}')} AS {c}_z" for c in L.BASE_FEATURES)
_MOMENTS = ", ".join(f"avg(ln(1 + {c})) AS m_{c}, stddev_pop(ln(1 + {c})) AS s_{c}" for c in L.BASE_FEATURES)


@query("p17_preprocessing", f"""
WITH {FEATURES}, mo AS (SELECT {_MOMENTS} FROM lab WHERE split = 'train')
SELECT customer_id, split, {_Z} FROM lab CROSS JOIN mo""")
def p17_preprocessing(t):
    """log1p + standardisation fitted on the training split, applied to every customer."""
    df = materialize(labelled(t))
    prep = L.preprocessing(df.where(F.col("split") == "train"), L.BASE_FEATURES)
    return prep.transform(df).select("customer_id", "split", *[r6(f"{c}_z").alias(f"{c}_z") for c in L.BASE_FEATURES])


@query("p18_default_classifiers")
def p18_default_classifiers(t):
    """LR / DT / RF with default settings: held-out metrics per model."""
    df, _ = _frames(t)
    train, test = df.where(F.col("split") == "train"), df.where(F.col("split") == "test")
    return _union([E.metrics(L.fit_with(train, name, {}).transform(test)).withColumn("model", F.lit(name))
                   for name in L.MODELS])


@query("p19_folds", f"""
WITH {FEATURES},
tr AS (SELECT customer_id, label, count(*) OVER (PARTITION BY label) - 1 AS m,
              row_number() OVER (PARTITION BY label ORDER BY {S.unit_hash('customer_id', 'cv42')}) - 1 AS r
       FROM lab WHERE split = 'train')
SELECT customer_id, label, CAST((r * 5 > m) AS INTEGER) + CAST((r * 5 > m * 2) AS INTEGER)
         + CAST((r * 5 > m * 3) AS INTEGER) + CAST((r * 5 > m * 4) AS INTEGER) AS fold FROM tr""")
def p19_folds(t):
    """The fold of every training customer: five folds, exact within each label."""
    return _frames(t)[1].select("customer_id", "label", "fold")


def _best_settings(t, names):
    rows = [(name, json.dumps(params, sort_keys=True), sum(f1) / len(f1))
            for name, (_, params, f1) in ((n, _tuned(t, n)) for n in names)]
    return t.spark.createDataFrame(rows, "model string, best_params string, cv_f1 double")


@query("p19_grid_search")
def p19_grid_search(t):
    """5-fold grid search (F1 of the positive class): best settings and CV F1 per family."""
    return _best_settings(t, L.MODELS)


@query("p19_grid_logistic_regression")
def p19_grid_logistic_regression(t):
    """The 5 points of logistic regression."""
    return _best_settings(t, ["logistic_regression"])


@query("p19_grid_decision_tree")
def p19_grid_decision_tree(t):
    """The 70 points of the decision tree."""
    return _best_settings(t, ["decision_tree"])


@query("p19_grid_random_forest")
def p19_grid_random_forest(t):
    """The 64 points of the random forest."""
    return _best_settings(t, ["random_forest"])


@query("p24_tuned_model_comparison")
def p24_tuned_model_comparison(t):
    """Tuned models: held-out metrics, AUC, CV F1 mean/sd, train accuracy, gap; best F1 first."""
    b = bundle(t)
    test = b["df"].where(F.col("split") == "test")
    parts = []
    for name, (model, _, f1) in b["tuned"].items():
        pt = model.transform(test).withColumn("score", vector_to_array("probability")[1])
        met = E.metrics(pt).crossJoin(E.roc_auc(pt))
        tr_acc = E.metrics(model.transform(b["train"])).select(F.col("accuracy").alias("train_accuracy"))
        cv = _fold_scores(t.spark, f1).agg(F.avg("f1").alias("cv_f1_mean"), F.stddev_pop("f1").alias("cv_f1_std"),
                                           F.count("f1").alias("folds"))
        parts.append(met.crossJoin(tr_acc).crossJoin(cv).withColumn("model", F.lit(name))
                     .withColumn("overfit_gap", F.col("train_accuracy") - F.col("accuracy")))
    return _union(parts).orderBy(F.desc("f1"))


@query("p29_feature_importance")
def p29_feature_importance(t):
    """Impurity importances (trees) and standardised coefficients (LR), long form."""
    b = bundle(t)
    return L.importances(t.spark, {n: m for n, (m, _, _) in b["tuned"].items()})


@query("p30_scored_customers")
def p30_scored_customers(t):
    """Every modelled customer scored by the best held-out-F1 model, highest probability first."""
    b = bundle(t)
    name = _best_name(b)
    return L.score(b["tuned"][name][0], b["df"], name).orderBy(F.desc("probability"))


@query("p30_accuracy_by_split")
def p30_accuracy_by_split(t):
    """Accuracy of the scored list per data split (train is in-sample)."""
    s = p30_scored_customers(t.spark, t.root)
    return s.groupBy("data_split").agg(F.count(F.lit(1)).alias("customers"),
                                       F.avg(F.col("correct").cast("double")).alias("accuracy"))


@query("p31_decision_record")
def p31_decision_record(t):
    """One-row JSON decision record with every value computed from the data."""
    b = bundle(t)
    best = _best_name(b)
    n1, n2 = sorted(b["tuned"], key=lambda n: -sum(b["tuned"][n][2]))[:2]
    (m1, _, f1), (m2, _, f2) = b["tuned"][n1], b["tuned"][n2]
    fa, fb = _fold_scores(t.spark, f1), _fold_scores(t.spark, f2)
    tt = E.with_t_pvalues(E.paired_t(fa, fb)).first()
    test = b["df"].where(F.col("split") == "test")
    mc = E.mcnemar(m1.transform(test), m2.transform(test), "customer_id").first()
    lab = P.label_summary(b["df"]).first()
    inv = retail.invoices(t)
    cold = P.cold_start(inv, CUTOFF, "inv_ts").first()
    win = P.split_integrity(inv, CUTOFF, "inv_ts").first()

    def p_text(p):
        return "not defined" if p is None else f"{p:.3f}"
    rec = {
        "recommended_model": best,
        "compared_models": [n1, n2], "recommended_model_compared": best in (n1, n2),
        "corrected_paired_t_p": tt["p_corrected"], "mcnemar_p": mc["p_value"],
        "models_statistically_indistinguishable": bool((tt["p_corrected"] is None or tt["p_corrected"] > 0.05) and mc["p_value"] > 0.05),
        "label_threshold": lab["threshold"], "n_customers_modelled": lab["n"],
        "majority_class_baseline_accuracy": lab["majority_baseline"],
        "excluded_cold_start_customers": cold["cold_start"],
        "observation_window_days": win["obs_days"], "future_window_days": win["future_days"],
        "cutoff": CUTOFF, "state_feature_excluded": True,
        "reason": (f"{best} has the best held-out F1; the two best cross-validated models differ with "
                   f"corrected paired t p={p_text(tt['p_corrected'])} and McNemar p={p_text(mc['p_value'])}."),
    }
    return L.decision_record(t.spark, rec)


@query("p33_feature_ablation")
def p33_feature_ablation(t):
    """CV F1 of the three fixed models with and without the state."""
    _, train = _frames(t)
    rows = []
    for variant, one_hot in (("without_state", None), ("with_state", "state")):
        with L.fold_frames(train, one_hot=one_hot) as folds:
            for name, params in L.FIXED.items():
                f1 = L.cross_validate(folds, name, [params])[0]
                rows.append((name, variant, sum(f1) / len(f1)))
    return t.spark.createDataFrame(rows, "model string, variant string, cv_f1 double")


def _cv_f1(train, features, settings):
    """Mean F1 over the folds of ``train`` for each (model, params)."""
    # boosting binds the rows of several partitions to each core itself: small partitions make small blocks
    rows = L.ROWS_PER_PARTITION if "gradient_boosting" in settings else L.TREE_ROWS_PER_PARTITION
    with L.fold_frames(train, features, rows=rows) as folds:
        return {name: sum(f1) / len(f1)
                for name, (f1,) in ((n, L.cross_validate(folds, n, [p])) for n, p in settings.items())}


def _rich(t):
    """Rich features of every modelled customer with split, label, and the fold of training rows."""
    df, train = _frames(t)
    rich = P.rich_features(retail.invoices(t), retail.lines(t), CUTOFF)
    return materialize(rich.join(df.select("customer_id", "split", "label"), "customer_id")
                       .join(train.select("customer_id", "fold"), "customer_id", "left"))


@query("p34_feature_gain")
def p34_feature_gain(t):
    """CV F1 of the three fixed models on the 5 base and on the 16 rich features."""
    rich = _rich(t).where(F.col("split") == "train")
    base_f1, rich_f1 = _cv_f1(rich, L.BASE_FEATURES, L.FIXED), _cv_f1(rich, L.RICH_FEATURES, L.FIXED)
    rows = [(n, base_f1[n], rich_f1[n], rich_f1[n] - base_f1[n]) for n in L.FIXED]
    return t.spark.createDataFrame(rows, "model string, cv_f1_base double, cv_f1_rich double, rich_gain double")


@query("p34_tuning_and_feature_gain")
def p34_tuning_and_feature_gain(t):
    """CV F1 of the defaults and of the tuned settings, beside the gain from rich features."""
    b = bundle(t)
    default = _cv_f1(b["train"], L.BASE_FEATURES, {n: L.DEFAULTS[n] for n in L.MODELS})
    rows = [(n, default[n], sum(f1) / len(f1)) for n, (_, _, f1) in b["tuned"].items()]
    return (t.spark.createDataFrame(rows, "model string, cv_f1_default double, cv_f1_tuned double")
            .withColumn("tuning_gain", F.col("cv_f1_tuned") - F.col("cv_f1_default"))
            .join(p34_feature_gain(t.spark, t.root), "model"))


@query("p35_gradient_boosting")
def p35_gradient_boosting(t):
    """Gradient-boosted trees on the 16 rich features: CV F1, held-out metrics and AUC."""
    df = _rich(t)
    train = df.where(F.col("split") == "train")
    # the two share the cores: a level of a tree is one short job
    cv, m = in_parallel(t.spark, lambda run: run(), [
        lambda: _cv_f1(train, L.RICH_FEATURES, {"gradient_boosting": {}})["gradient_boosting"],
        lambda: L.fit_with(train, "gradient_boosting", {}, L.RICH_FEATURES)])
    pt = m.transform(df.where(F.col("split") == "test")).withColumn("score", vector_to_array("probability")[1])
    return (E.metrics(pt).crossJoin(E.roc_auc(pt)).withColumn("model", F.lit("gradient_boosting"))
            .withColumn("cv_f1", F.lit(cv)))


@query("p36_learning_curve")
def p36_learning_curve(t):
    """Mean train / validation accuracy over folds for 8 training fractions: the fixed random
    forest on the 16 rich features."""
    train = _rich(t).where(F.col("split") == "train")
    fr = [round(0.1 + i * 0.9 / 7, 4) for i in range(8)]
    rows = L.learning_curve(train, "random_forest", L.FIXED["random_forest"], fr, L.RICH_FEATURES)
    df = t.spark.createDataFrame(rows, "fraction double, fold int, train_accuracy double, val_accuracy double")
    return df.groupBy("fraction").agg(F.avg("train_accuracy").alias("train_accuracy"),
                                      F.avg("val_accuracy").alias("val_accuracy"))


@query("p37_top_quartile_model")
def p37_top_quartile_model(t):
    """Random forest (200 trees, depth 8) on the top-quartile target: metrics + baseline."""
    rich = materialize(P.rich_features(retail.invoices(t), retail.lines(t), CUTOFF))
    q = quantiles(rich, "future_spend", [0.75], names=["q75"])
    df = materialize(P.stratified_split(rich).crossJoin(F.broadcast(q))
                     .withColumn("label", (F.col("future_spend") > F.col("q75")).cast("int")))
    m = L.fit_with(df.where(F.col("split") == "train"), "random_forest", L.FIXED["random_forest"], L.RICH_FEATURES)
    pt = m.transform(df.where(F.col("split") == "test")).withColumn("score", vector_to_array("probability")[1])
    base = df.agg(F.avg("label").alias("_p")).select(F.greatest("_p", 1 - F.col("_p")).alias("majority_baseline"))
    return E.metrics(pt).crossJoin(E.roc_auc(pt)).crossJoin(base)
