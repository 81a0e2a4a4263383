import numpy as np
import pytest

from tillroll.functions.hashing import unit_hash
from tillroll.operators import nearest as N
from pyspark.sql import functions as F


def points(kind):
    rng = np.random.default_rng(3)
    if kind == "hot":      # a third in one place, a third in a tiny region, far outliers
        p = np.concatenate([np.full((200, 3), 0.25), 0.5 + 1e-9 * rng.random((200, 3)), rng.random((197, 3)), 1e6 * rng.random((3, 3))])
    elif kind == "line":   # one axis without width, many ties
        p = np.stack([np.arange(300) // 2 * 1.0, np.zeros(300), np.arange(300) % 7 * 1.0], axis=1)
    else:
        p = rng.random((300, 3))
    return p


def brute(p, ids, seeds, draws, places):
    out = []
    for s in seeds:
        w = [np.sqrt(((np.delete(p, i, 0) - p[i]) ** 2).sum(1).min()) for i in ids if draws[s, i]]
        u = [np.sqrt(((p - places[s, i]) ** 2).sum(1).min()) for i in ids if draws[s, i]]
        if sum(u) + sum(w) > 0:
            out.append(sum(u) / (sum(u) + sum(w)))
    return np.mean(out)


@pytest.mark.parametrize("kind", ["hot", "line", "even"])
def test_hopkins_is_that_of_all_pairs(spark, kind, monkeypatch):
    if kind == "line":
        monkeypatch.setattr(N, "BROADCAST_BOXES", 3)  # the shuffled, salted joins
    p = points(kind)
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(p)], "id long, x double, y double, z double")
    seeds = [0, 1]
    lo, hi = p.min(0), p.max(0)
    draws, places = {}, {}
    for s in seeds:
        for r in df.select("id", unit_hash("id", F.lit(f"draw{s}")).alias("d"),
                           *[unit_hash("id", F.lit(f"axis{i}"), F.lit(str(s))).alias(f"u{i}") for i in range(3)]).collect():
            draws[s, r.id] = r.d < 0.1
            places[s, r.id] = lo + np.array([r.u0, r.u1, r.u2]) * (hi - lo)
    got = N.hopkins(df, "id", ["x", "y", "z"], seeds, leaf=8).first()
    assert got.seeds == 2
    assert got.hopkins == pytest.approx(brute(p, range(len(p)), seeds, draws, places), rel=1e-9)


def test_hopkins_of_nothing(spark):
    none = spark.createDataFrame([(1, None), (2, float("nan"))], "id long, x double")
    assert N.hopkins(none, "id", ["x"]).first().hopkins is None
    same = spark.createDataFrame([(i, 1.0) for i in range(50)], "id long, x double")
    assert N.hopkins(same, "id", ["x"]).first().hopkins is None


def test_clustered_points_score_higher(spark):
    rng = np.random.default_rng(5)
    tight = np.concatenate([c + 0.01 * rng.standard_normal((150, 2)) for c in ([0, 0], [1, 1], [0, 1])])
    even = rng.random((450, 2))
    h = [N.hopkins(spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(p)], "id long, x double, y double"),
                   "id", ["x", "y"]).first().hopkins for p in (tight, even)]
    assert h[0] > 0.9 and 0.35 < h[1] < 0.65


def test_queries_write_no_row_for_each_box(spark, monkeypatch):
    written = []

    def counted(df, write=N.materialize):
        out = write(df)
        if "bound" in out.columns:
            written.append(out.count())
        return out
    monkeypatch.setattr(N, "materialize", counted)
    rng = np.random.default_rng(11)
    rows = lambda n: [tuple(map(float, r)) for r in rng.random((n, 3))]
    places = spark.createDataFrame(rows(4000), "x0 double, x1 double, x2 double")
    queries = spark.createDataFrame([(i, False, *r) for i, r in enumerate(rows(200))],
                                    "id long, real boolean, a0 double, a1 double, a2 double")
    assert N.nearest(queries, ["id"], places, 3, "real", leaf=8).count() == 200
    assert sum(written) <= 2 * 200


def test_hot_boxes_are_copied(spark, monkeypatch):
    monkeypatch.setattr(N, "BROADCAST_BOXES", 1)
    monkeypatch.setattr(N, "HOT_ROWS", 5)
    rng = np.random.default_rng(12)
    p, q = rng.random((200, 2)), np.concatenate([rng.random((30, 2)), np.full((30, 2), 0.3)])
    places = spark.createDataFrame([tuple(map(float, r)) for r in p], "x0 double, x1 double")
    queries = spark.createDataFrame([(i, False, *map(float, r)) for i, r in enumerate(q)], "id long, real boolean, a0 double, a1 double")
    got = {r.id: r.distance for r in N.nearest(queries, ["id"], places, 2, "real", leaf=8).collect()}
    assert [got[i] for i in range(60)] == pytest.approx([np.sqrt(((p - v) ** 2).sum(1).min()) for v in q])
