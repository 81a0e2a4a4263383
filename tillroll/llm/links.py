"""Linking by shared keys: bounded candidate groups and connected components.

Both steps are distributed.  A key that many rows share is never handled as one
group: its rows are dealt into chunks, and each pair of chunks is a group of its
own, so a group holds at most about two chunks whatever the data.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Hot-key tables of up to this many rows (24 bytes each) are broadcast; larger ones are joined by a shuffle.
BROADCAST_KEYS = 50_000


def _groups(frames: Iterator[pd.DataFrame], by: list[str]) -> Iterator[pd.DataFrame]:
    """Whole groups of frames sorted by ``by``; a group may span several frames."""
    held: list[pd.DataFrame] = []
    for pdf in frames:
        if not len(pdf):
            continue
        keys = pdf[by]
        starts = (keys != keys.shift()).any(axis=1).to_numpy().nonzero()[0].tolist()
        if held and (held[-1][by].iloc[-1] == keys.iloc[0]).all():
            starts = starts[1:]
        else:
            if held:
                yield pd.concat(held)
            held = []
            starts = starts[1:]
        at = 0
        for s in starts:
            yield pd.concat([*held, pdf.iloc[at:s]]) if held else pdf.iloc[at:s]
            held, at = [], s
        held.append(pdf.iloc[at:])
    if held:
        yield pd.concat(held)


def candidate_groups(rows: DataFrame, link: Callable[[pd.DataFrame, pd.DataFrame | None, int], pd.DataFrame],
                     schema: str, chunk: int) -> DataFrame:
    """Apply ``link`` to the rows of each key.

    rows: (k1 int, k2 long, node long, code long).  ``link(left, right, k1)`` gets
    the rows of one key (right None: pairs within left), or two different chunks
    of a hot key (pairs across).  Keys with one row are dropped; every pair of
    rows that shares a key meets in exactly one call per shared key.
    """
    counts = cut(rows.groupBy("k1", "k2").agg(F.count("*").alias("n")).where("n > 1"), "key-counts", True)
    hot = counts.where(F.col("n") > chunk)
    n_hot = hot.count()
    one = F.lit(0)
    if n_hot:
        side = F.broadcast(hot) if n_hot <= BROADCAST_KEYS else hot
        marked = rows.join(side, ["k1", "k2"], "left")
        parts = F.coalesce(F.ceil(F.col("n") / chunk), F.lit(1)).cast("int")
        marked = marked.withColumn("parts", parts) \
            .withColumn("mine", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")) \
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        dealt = marked.select("k1", "k2", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"),
                              "mine", "node", "code")
    else:
        dealt = rows.select("k1", "k2", one.alias("a"), one.alias("b"), one.alias("mine"), "node", "code")
    by = ["k1", "k2", "a", "b"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, held = [], 0
        for g in _groups(frames, by):
            if len(g) < 2:
                continue
            k1, a, b = int(g["k1"].iloc[0]), int(g["a"].iloc[0]), int(g["b"].iloc[0])
            if a == b:
                found = link(g, None, k1)
            else:
                left = (g["mine"] == a).to_numpy()
                found = link(g[left], g[~left], k1)
            if len(found):
                out.append(found)
                held += len(found)
            if held > 50_000:
                yield pd.concat(out)
                out, held = [], 0
        if out:
            yield pd.concat(out)

    return dealt.repartition(*by).sortWithinPartitions(*by).mapInPandas(run, schema)


def components(edges: DataFrame) -> DataFrame:
    """Connected components by alternating large-star and small-star rounds.

    edges: (u long, v long); self-loops and repeats are allowed.  Returns one row
    per node that has an edge to another node: (node, root), root being the
    smallest node of its component (the root itself is left out).
    """
    e = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
            "edges", True)
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        e = cut(small, "edges", True)
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
