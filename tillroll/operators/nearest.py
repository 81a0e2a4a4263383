"""Exact nearest neighbours in a few dimensions, and the Hopkins statistic (K10) on them.

Points become distinct places.  A box of more than ``leaf`` places is cut in ``PARTS`` along each side of its tight
bounds, as often as it takes: every cut parts its two extreme places, so a hot region just gets more levels.  A query
walks the levels down twice: first as one row, to the nearest box of each level, which bounds its distance by the far
corners on the way and the places of the leaf (a short list) it ends in; then to all boxes that begin within that
bound, few of them, whose leaves give it exactly.  Boxes are compared inside the query's row, so nothing pairs the
queries with the points, and only boxes within the bound become rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import unit_hash
from ..session import materialize

PARTS = 4
#: So many boxes (at most ``leaf`` places, or the corners of ``PARTS`` ** d boxes each) are broadcast; more are joined by a
#: shuffle, with a copy of a box for every ``HOT_ROWS`` rows that ask for it.
BROADCAST_BOXES = 20_000
HOT_ROWS = 20_000
#: Levels that are walked before the rows are written.
STRIDE = 4


def _axes(prefix: str, d: int) -> list[str]:
    return [f"{prefix}{i}" for i in range(d)]


def _join(rows: DataFrame, boxes: DataFrame, key: str, how: str, spread: Column) -> DataFrame:
    """``rows`` with their boxes; a box that many rows ask for is copied, not its rows gathered."""
    if boxes.limit(BROADCAST_BOXES + 1).count() <= BROADCAST_BOXES:
        return rows.join(F.broadcast(boxes), key, how)
    rows = materialize(rows)
    hot = materialize(rows.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / HOT_ROWS).alias("_copies")).where("_copies > 1"))
    copies = F.coalesce("_copies", F.lit(1))
    copied = boxes.join(F.broadcast(hot), key, "left") \
        .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1))).drop("_copies")
    salted = rows.join(F.broadcast(hot), key, "left").withColumn("_salt", F.pmod(F.xxhash64(spread), copies)).drop("_copies")
    return salted.join(copied, [key, "_salt"], how).drop("_salt")


def box_levels(places: DataFrame, d: int, leaf: int = 64) -> list[DataFrame]:
    """The boxes of distinct places (columns x0..): for each level (parent, path, lo.., hi.., spots), ``spots`` the
    places of a box that is not cut any more."""
    x = _axes("x", d)
    rows = places.select(*x, F.lit(None).cast("string").alias("parent"), F.lit("").alias("path"))
    levels = []
    while True:
        sizes = materialize(rows.groupBy("parent", "path").agg(
            F.count(F.lit(1)).alias("c"), *[f(f"x{i}").alias(f"{k}{i}") for i in range(d) for k, f in (("lo", F.min), ("hi", F.max))]))
        wide = sizes.where(F.col("c") > leaf).drop("c", "parent")
        more = wide.limit(1).count() > 0
        marked = materialize(_join(rows, wide.withColumn("_wide", F.lit(True)), "path", "left", F.struct(*x))) if more else rows
        spots = (marked.where(F.col("_wide").isNull()) if more else marked).groupBy("path") \
            .agg(F.collect_list(F.array(*x)).alias("spots"))  # at most ``leaf``
        levels.append(materialize(sizes.drop("c").join(spots, "path", "left")))
        if not more:
            return levels

        def part(i):
            lo, hi, v = F.col(f"lo{i}"), F.col(f"hi{i}"), F.col(f"x{i}")
            return F.when(hi > lo, F.least(F.floor((v - lo) / (hi - lo) * PARTS), F.lit(PARTS - 1))).otherwise(F.lit(0))
        place = reduce(lambda code, i: code * PARTS + part(i), range(1, d), part(0))
        rows = marked.where("_wide").select(*x, F.col("path").alias("parent"), F.concat_ws("/", "path", place.cast("string")).alias("path"))


def nearest(queries: DataFrame, key: Sequence[str], places: DataFrame, d: int, others: str, leaf: int = 64) -> DataFrame:
    """(key.., distance) from each query (unique key, coordinates a0..) to the nearest of the distinct ``places``
    (x0..); where the boolean column ``others`` holds, a place equal to the query does not count.  Queries without
    such a place have no row."""
    key, a = list(key), _axes("a", d)
    levels = box_levels(places, d, leaf)
    kids = [boxes.groupBy(F.coalesce("parent", F.lit("")).alias("at")).agg(F.collect_list(F.struct(  # at most PARTS ** d
        "path", *[f"{k}{i}" for i in range(d) for k in ("lo", "hi")])).alias("kids")) for boxes in levels]
    leaves = reduce(DataFrame.unionByName, [b.where("spots IS NOT NULL").select(F.col("path").alias("at"), "spots") for b in levels])

    def near(box):
        total = F.lit(0.0)
        for i, c in enumerate(a):
            gap = F.greatest(box[f"lo{i}"] - F.col(c), F.lit(0.0), F.col(c) - box[f"hi{i}"])
            total = total + gap * gap
        return total

    def far(box):  # a box of more than one place holds one that is not the query's own
        total, own = F.lit(0.0), F.col(others)
        for i, c in enumerate(a):
            span = F.greatest(F.abs(box[f"hi{i}"] - F.col(c)), F.abs(F.col(c) - box[f"lo{i}"]))
            total, own = total + span * span, own & (box[f"lo{i}"] == F.col(c)) & (box[f"hi{i}"] == F.col(c))
        return F.when(~own, total)

    def apart(spot):
        total, same = F.lit(0.0), F.lit(True)
        for i, c in enumerate(a):
            total, same = total + (spot[i] - F.col(c)) * (spot[i] - F.col(c)), same & (spot[i] == F.col(c))
        return F.when(~(F.col(others) & same), total)

    def walk(rows, step):
        for depth, boxes in enumerate(kids):
            rows = step(_join(rows, boxes, "at", "left", F.struct(*key)))  # a row at a leaf stays there
            if depth % STRIDE == STRIDE - 1 and depth + 1 < len(kids):
                rows = materialize(rows)
        return _join(rows, leaves, "at", "inner", F.struct(*key)).withColumn("d2", F.array_min(F.transform("spots", apart)))

    def to_nearest(met):
        first = F.array_min(F.transform("kids", lambda b: F.struct(near(b).alias("near"), b["path"].alias("path"))))
        return met.select(*key, others, *a, F.coalesce(first["path"], "at").alias("at"),
                          F.least("bound", F.array_min(F.transform("kids", far))).alias("bound"))

    def to_all_within(met):
        within = F.transform(F.filter("kids", lambda b: near(b) <= F.col("bound")), lambda b: b["path"])
        return met.select(*key, others, *a, "bound", F.explode(F.coalesce(within, F.array("at"))).alias("at"))

    start = queries.select(*key, others, *a, F.lit("").alias("at"), F.lit(None).cast("double").alias("bound"))
    bound = materialize(walk(start, to_nearest).select(*key, others, *a, F.lit("").alias("at"), F.least("bound", "d2").alias("bound")))
    return walk(bound, to_all_within).groupBy(*key).agg(F.sqrt(F.min("d2")).alias("distance")).where("distance IS NOT NULL")


def hopkins(points: DataFrame, id_col: str, cols: Sequence[str], seeds: Sequence[int] = range(5), share: float = 0.1,
            leaf: int = 64) -> DataFrame:
    """One row (seeds, hopkins), the mean over the seeds of sum(u) / (sum(u) + sum(w)): w is the distance from a
    drawn point to the nearest other point, u that from a place drawn evenly in the bounding box to the nearest point.

    A point is drawn by the hash of its id, about ``share`` of them, and draws one such place.  Points with a null or NaN
    coordinate are left out, ids are unique; a seed that draws nothing, or only sums to 0, does not count (null if none does)."""
    d = len(cols)
    known = reduce(lambda p, c: p & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")), cols, F.lit(True))
    pts = materialize(points.where(known).select(F.col(id_col).alias("id"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)]))
    x = _axes("x", d)
    places = materialize(pts.groupBy(*x).agg(F.count(F.lit(1)).alias("n")))
    box = places.agg(*[f(c).alias(f"{k}_{c}") for c in x for k, f in (("lo", F.min), ("hi", F.max))])
    drawn = materialize(pts.withColumn("seed", F.explode(F.array(*map(F.lit, seeds))))
                        .where(unit_hash(F.col("id"), F.concat(F.lit("draw"), F.col("seed").cast("string"))) < share))
    alone = drawn.join(places.where("n = 1").select(*x), x, "left_semi")  # a copy is at distance 0
    real = alone.select("id", "seed", F.lit(True).alias("real"), *[F.col(c).alias(f"a{i}") for i, c in enumerate(x)])
    even = drawn.select("id", "seed").crossJoin(F.broadcast(box)).select("id", "seed", F.lit(False).alias("real"), *[
        (F.col(f"lo_{c}") + unit_hash(F.col("id"), F.concat_ws("|", F.lit(f"axis{i}"), "seed")) * (F.col(f"hi_{c}") - F.col(f"lo_{c}"))).alias(f"a{i}")
        for i, c in enumerate(x)])
    far = nearest(real.unionByName(even), ["seed", "id", "real"], places.select(*x), d, "real", leaf)
    per_seed = far.groupBy("seed").agg(F.sum(F.when(~F.col("real"), F.col("distance")).otherwise(0.0)).alias("u"), F.sum("distance").alias("all"))
    return per_seed.agg(F.lit(len(list(seeds))).cast("long").alias("seeds"), F.avg(F.when(F.col("all") > 0, F.col("u") / F.col("all"))).alias("hopkins"))
