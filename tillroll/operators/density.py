"""DBSCAN (K16): density labels and clusters of points in a few dimensions.

Grid of side eps / sqrt(d): two points of one cell are always within eps, so every point of a cell of at least
``min_samples`` points is core, and the core points of a cell belong together.  What is left are questions between
neighbouring cells, and they are answered without pairing their points: a cell's points are held by boxes, the
tight bounds of their coordinates.  A box wholly within eps of a point (or of another box) counts as a whole, one wholly
beyond eps not at all, and only boxes that the distance cuts are split, ``SPLIT_BITS`` halvings an axis each
round.  A box of one place is always decided, so a cell of any size costs the boxes along one sphere.  Each round is
one grouping of the points (partial sums first) and one join of boxes.

``min_samples`` counts the point itself.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import in_parallel, materialize
from .components import components

SPLIT_BITS = 2
#: Beyond so many halvings places are told apart by their coordinates themselves.
LAST_BIT = 48
#: A list of so many cells (a few numbers each) is broadcast; a longer one is joined by a shuffle.
BROADCAST_CELLS = 100_000


def _names(prefix: str, d: int) -> list[str]:
    return [f"{prefix}{i}" for i in range(d)]


def _cols(prefix: str, d: int) -> list[Column]:
    return [F.col(c) for c in _names(prefix, d)]


def _renamed(df: DataFrame, d: int, keep: Sequence[str] = (), **prefixes: str) -> DataFrame:
    return df.select(*keep, *[F.col(f"{a}{i}").alias(f"{b}{i}") for a, b in prefixes.items() for i in range(d)])


def _reach(lo: list[Column], hi: list[Column], lo2: list[Column], hi2: list[Column]) -> tuple[Column, Column]:
    """(least, most) squared distance between the points of two boxes."""
    near, far = F.lit(0.0), F.lit(0.0)
    for a, b, c, e in zip(lo, hi, lo2, hi2):
        gap, span = F.greatest(c - b, F.lit(0.0), a - e), F.greatest(F.abs(e - a), F.abs(b - c))
        near, far = near + gap * gap, far + span * span
    return near, far


def _cells(points: DataFrame, id_col: str, cols: Sequence[str], side: float) -> DataFrame:
    d = len(cols)
    pts = points.select(F.col(id_col).alias("id"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    return pts.select("*", *[F.floor(F.col(f"x{i}") / side).cast("bigint").alias(f"c{i}") for i in range(d)])


def _boxes(pts: DataFrame, d: int, side: float, bits: int, extra: Sequence[Column] = ()) -> DataFrame:
    """The boxes of each cell after ``bits`` halvings: cell c, place s, place p of the box it came from, n, bounds."""
    parts = 1 << min(bits, LAST_BIT)
    s = [F.least(F.greatest(F.floor((x / side - c) * parts), F.lit(0)), F.lit(parts - 1)).cast("bigint").alias(f"s{i}")
         for i, (x, c) in enumerate(zip(_cols("x", d), _cols("c", d)))]
    own = _names("x", d) if bits > LAST_BIT else []
    keyed = pts.select("*", *s)
    grouped = keyed.groupBy(*_names("c", d), *_names("s", d), *[F.col(c).alias(f"_{c}") for c in own]).agg(
        F.count(F.lit(1)).alias("n"), *[f(f"x{i}").alias(f"{k}{i}") for i in range(d) for k, f in (("lo", F.min), ("hi", F.max))], *extra)
    back = SPLIT_BITS if bits <= LAST_BIT else 0
    return grouped.withColumns({f"p{i}": F.shiftright(f"s{i}", back) for i in range(d)}).drop(*[f"_{c}" for c in own])


def _listed(cells: DataFrame) -> DataFrame:
    """A materialised table of cells for a join with points: the points stay where they are if it is short."""
    return F.broadcast(cells) if cells.count() <= BROADCAST_CELLS else cells


def _within(pts: DataFrame, open_: DataFrame, d: int, prefix: str) -> DataFrame:
    """The points of the cells that ``open_`` names (columns ``prefix``)."""
    cells = materialize(_renamed(open_, d, **{prefix: "c"}).distinct())
    return pts.join(_listed(cells), _names("c", d), "left_semi")


def _neighbours(df: DataFrame, d: int, reach: int, half: bool = False) -> DataFrame:
    """``df`` with each neighbouring cell t of its cell c, the cell itself included; ``half``: each pair of cells once."""
    offsets = [o for o in itertools.product(range(-reach, reach + 1), repeat=d) if not half or o > (0,) * d]
    off = F.explode(F.array(*[F.array(*map(F.lit, o)) for o in offsets]))
    return df.withColumn("_o", off).withColumns({f"t{i}": F.col(f"c{i}") + F.col("_o")[i] for i in range(d)}).drop("_o")


def _hits(probes: DataFrame, pts: DataFrame, d: int, side: float, eps2: float, extra: Sequence[Column] = (),
          keep: Sequence[str] = ("n",)) -> DataFrame:
    """Boxes of ``pts`` wholly within reach of the probes (id, a: coordinates, t: cell): (id, keep...).  Together they
    hold every point within reach of the probe in that cell exactly once."""
    bits, found = 0, []
    open_, side_a = materialize(probes), _cols("a", d)
    while True:
        boxes = _renamed(_boxes(_within(pts, open_, d, "t"), d, side, bits, extra), d, keep,
                         c="t", s="s", p="p", lo="lo", hi="hi")
        if bits:
            joined = open_.join(boxes, [*_names("t", d), *_names("p", d)])
        else:
            joined = open_.join(boxes.drop(*_names("p", d)), _names("t", d))
        near, far = _reach(side_a, side_a, _cols("lo", d), _cols("hi", d))
        joined = materialize(joined.where(near <= eps2).withColumn("_whole", far <= eps2))
        found.append(joined.where("_whole").select("id", *keep))
        open_ = _renamed(joined.where(~F.col("_whole")), d, ["id"], a="a", t="t", s="p")
        if not open_.limit(1).count():
            return reduce(DataFrame.unionByName, found)
        bits += SPLIT_BITS


def _counted(pts: DataFrame, d: int, side: float, reach: int, eps2: float, min_samples: int) -> DataFrame:
    """pts with n_neighbors (null in dense cells, where it is at least ``min_samples``) and core."""
    size = materialize(pts.groupBy(*_names("c", d)).agg(F.count(F.lit(1)).alias("cnt")))
    sized = pts.join(_listed(size), _names("c", d))
    columns = ["id", *_names("x", d), *_names("c", d)]
    dense = sized.where(F.col("cnt") >= min_samples).select(*columns, F.lit(None).cast("bigint").alias("n_neighbors"), F.lit(True).alias("core"))
    if not size.where(F.col("cnt") < min_samples).limit(1).count():
        return materialize(dense)
    sparse = materialize(sized.where(F.col("cnt") < min_samples).select(*columns))  # under min_samples points a cell
    probes = _neighbours(_renamed(sparse, d, ["id"], x="a", c="c"), d, reach).drop(*_names("c", d))
    probes = probes.join(_listed(_renamed(size, d, c="t")), _names("t", d), "left_semi")
    counts = _hits(probes, pts, d, side, eps2).groupBy("id").agg(F.sum("n").alias("n_neighbors"))
    return materialize(dense.unionByName(sparse.join(counts, "id", "left").select(
        *columns, "n_neighbors", (F.coalesce("n_neighbors", F.lit(0)) >= min_samples).alias("core"))))


def _linked_cells(core: DataFrame, d: int, side: float, reach: int, eps2: float) -> DataFrame:
    """Pairs of cells (c, t) with core points within reach of each other."""
    cells = core.select(*_names("c", d)).distinct()
    pairs = _neighbours(cells, d, reach, half=True).join(_renamed(cells, d, c="t"), _names("t", d))
    both = [*_names("c", d), *_names("t", d)]
    bits, linked, open_ = 0, [], pairs
    # a point of the box: two such points within reach settle the pair (one aggregation reads all coordinates off one row)
    one = [F.first(f"x{i}").alias(f"one{i}") for i in range(d)]
    while True:
        inside = core if not bits else _within(core, _renamed(open_, d, c="u").unionByName(_renamed(open_, d, t="u")), d, "u")
        boxes = materialize(_boxes(inside, d, side, bits, one))
        own = boxes.select(*_names("c", d), *[F.col(f"{k}{i}").alias(f"{k}_c{i}") for k in ("s", "p", "lo", "hi", "one") for i in range(d)])
        other = boxes.select(*[F.col(f"c{i}").alias(f"t{i}") for i in range(d)],
                             *[F.col(f"{k}{i}").alias(f"{k}_t{i}") for k in ("s", "p", "lo", "hi", "one") for i in range(d)])
        on_c, on_t = ([*_names("c", d)], [*_names("t", d)]) if not bits else \
            ([*_names("c", d), *_names("p_c", d)], [*_names("t", d), *_names("p_t", d)])
        joined = open_.join(own.drop(*([] if bits else _names("p_c", d))), on_c).join(other.drop(*([] if bits else _names("p_t", d))), on_t)
        near, far = _reach(_cols("lo_c", d), _cols("hi_c", d), _cols("lo_t", d), _cols("hi_t", d))
        apart = sum(((x - y) * (x - y) for x, y in zip(_cols("one_c", d), _cols("one_t", d))), F.lit(0.0))
        joined = materialize(joined.where(near <= eps2).withColumn("_linked", (far <= eps2) | (apart <= eps2)))
        done = materialize(joined.where("_linked").select(*both).distinct())
        linked.append(done)
        open_ = materialize(joined.where(~F.col("_linked")).join(done, both, "left_anti").select(
            *both, *[F.col(f"s_{k}{i}").alias(f"p_{k}{i}") for k in "ct" for i in range(d)]))
        if not open_.limit(1).count():
            return reduce(DataFrame.unionByName, linked)
        bits += SPLIT_BITS


def placed_dbscan(points: DataFrame, id_col: str, cols: Sequence[str], eps: float, min_samples: int = 10) -> DataFrame:
    """``dbscan`` with the coordinates x0, x1, ... (doubles) behind its columns."""
    d = len(cols)
    side = eps / math.sqrt(d)
    reach, eps2 = math.ceil(eps / side), eps * eps
    pts = _counted(_cells(points, id_col, cols, side), d, side, reach, eps2, min_samples)
    core, others = pts.where("core"), pts.where(~F.col("core"))
    cells = materialize(core.groupBy(*_names("c", d)).agg(F.min("id").alias("cell")))
    linked = _linked_cells(core, d, side, reach, eps2)
    edges = linked.join(cells.withColumnRenamed("cell", "u"), _names("c", d)) \
        .join(_renamed(cells, d, ["cell"], c="t").withColumnRenamed("cell", "v"), _names("t", d))
    roots = components(edges.select("u", "v"))
    named = materialize(cells.join(roots, F.col("cell") == F.col("node"), "left")
                        .select(*_names("c", d), F.coalesce("component", "cell").alias("cluster")))
    placed = core.join(_listed(named), _names("c", d))
    own = placed.select("id", F.lit("core").alias("label"), "cluster", *_names("x", d))
    if not others.limit(1).count():
        return own
    probes = _neighbours(_renamed(others, d, ["id"], x="a", c="c"), d, reach).drop(*_names("c", d))
    probes = probes.join(_listed(_renamed(named, d, c="t")), _names("t", d))  # cells with a core point
    border = _hits(probes, placed, d, side, eps2, [F.min("cluster").alias("cluster")], ["cluster"]).groupBy("id").agg(F.min("cluster").alias("cluster"))
    rest = others.select("id", *_names("x", d)).join(border, "id", "left") \
        .select("id", F.when(F.col("cluster").isNotNull(), F.lit("border")).otherwise(F.lit("noise")).alias("label"), "cluster", *_names("x", d))
    return own.unionByName(rest)


def dbscan(points: DataFrame, id_col: str, cols: Sequence[str], eps: float, min_samples: int = 10) -> DataFrame:
    """(id, label, cluster) with label core, border or noise.  A cluster is named by its smallest core id; a border point
    belongs to the smallest cluster with a core point within eps, noise to none.  Ids are unique and coordinates not null."""
    return placed_dbscan(points, id_col, cols, eps, min_samples).select("id", "label", "cluster")


def density_labels(points: DataFrame, id_col: str, cols: Sequence[str], eps: float, min_samples: int = 10) -> DataFrame:
    """(id, label) with label in {'core', 'border', 'noise'}."""
    return dbscan(points, id_col, cols, eps, min_samples).select("id", "label")


def density_summary(points: DataFrame, id_col: str, cols: Sequence[str], eps_list: Sequence[float],
                    min_samples: int = 10) -> DataFrame:
    """Per eps: number of clusters and of core, border and noise points."""
    def row(eps):
        return dbscan(points, id_col, cols, eps, min_samples).agg(
            F.lit(float(eps)).alias("eps"), F.countDistinct("cluster").alias("clusters"),
            *[F.count_if(F.col("label") == name).alias(name) for name in ("core", "border", "noise")])
    return reduce(DataFrame.unionByName, in_parallel(points.sparkSession, row, eps_list))
