"""A round of k-means adds the tasks' sums up in the driver where they are few, by a shuffle where they are many."""
import numpy as np
from pyspark.sql import functions as F

from tillroll.functions.hashing import unit_hash
from tillroll.operators import batch_kmeans as B
from tillroll.session import materialize


def test_few_sums_need_no_shuffle_and_give_the_same_centres(spark, monkeypatch):
    df = materialize(spark.range(900).select(
        F.array(*[unit_hash("id", seed=f"k{i}") + F.col("id") % 3 for i in range(2)]).alias("x"),
        F.array(F.lit(1.0), F.col("id") % 2.0).alias("w")).repartition(5))
    runs = [B.Run((k, s, w), "x", k, s, w) for k in (2, 3, 5) for s in (1, 2) for w in (None, 1)]

    def fitted(group):
        spark.sparkContext.setJobGroup(group, group)
        fits = B.fit_all(df, runs, weights="w", max_iter=20)
        tracker = spark.sparkContext.statusTracker()
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(group)]
        scores = B.silhouettes(df, {f.run.key: f for f in fits})
        return fits, scores, sum(len(j.stageIds) for j in jobs if j)
    few, few_scores, one = fitted("few")
    monkeypatch.setattr(B, "GATHERED", 0)
    many, many_scores, two = fitted("many")
    assert one < two
    for a, b in zip(few, many):
        assert np.allclose(a.centres, b.centres) and np.isclose(a.cost, b.cost)
    assert all(np.isclose(few_scores[k], many_scores[k]) for k in few_scores)
