"""SimHash near-duplicates through BK-tree shards.

Two fingerprints that differ in at most r bits agree on one of r + 1 blocks of
bits, so every pair that must be linked shares a shard (block, value).  Each
shard has one BK-tree: children are keyed by their Hamming distance to the
parent, and a search follows only edges within the radius.  Shards that would
be large are split by further blocks of the remaining bits, by the same
argument; what is still large after that is dealt into chunk trees, each
searched by the others' rows.  Trees stay with their shard's task instead of
being broadcast whole: all fingerprints together have no size bound.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut
from .links import candidate_groups, components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS = 64
#: Rows of a shard tree; larger shards are split.
SHARD = 256
#: Times a large shard is split by further blocks before it is dealt into chunks.
SPLITS = 2


def _bit_counts(h: np.ndarray) -> np.ndarray:
    """How many of the 64-bit hashes have each bit: eight byte-wide counters at a time, 255 rows each."""
    full = -len(h) % 255
    if full:
        h = np.concatenate([h, np.zeros(full, np.uint64)])
    counts = np.zeros(BITS, np.int64)
    lanes = np.uint64(0x0101010101010101)
    for j in range(8):
        sums = ((h >> np.uint64(j)) & lanes).reshape(-1, 255).sum(axis=1, dtype=np.uint64)
        counts[j::8] = sums.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return counts


def fingerprint(text: bytes | None, shingle: int = 4, seed: int = 42) -> int:
    """64-bit SimHash (unsigned) of the words of a text, A-Z lower-cased.

    Words are runs of bytes other than space and \\t\\n\\v\\f\\r.  Null, empty and
    blank texts: 0.  Fewer words than a shingle: the whole sequence is one shingle.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        parts = iter([b" ".join(words)])
        n = 1
    else:
        parts = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
        n = len(words) - shingle + 1
    counts = np.zeros(BITS, np.int64)
    hasher = partial(xxhash.xxh64_intdigest, seed=seed)
    for at in range(0, n, 1 << 16):
        size = min(1 << 16, n - at)
        counts += _bit_counts(np.fromiter(map(hasher, (p for _, p in zip(range(size), parts))), np.uint64, size))
    return int(sum(1 << i for i in np.flatnonzero(2 * counts > n).tolist()))


def fingerprints(docs: DataFrame, text: str, keep: list[str], shingle: int = 4, seed: int = 42) -> DataFrame:
    """The ``keep`` columns of every row with its fingerprint as a signed long ``fp``."""
    chosen = docs.select(*keep, F.col(text).cast("binary").alias("__text"))
    schema = docs.select(*keep).withColumn("fp", F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pa.default_memory_pool().release_unused()
            fp = np.array([fingerprint(t.as_py(), shingle, seed) for t in b.column(len(keep))], np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], pa.array(fp.view(np.int64))], [*keep, "fp"])

    return chosen.mapInArrow(run, schema)


class BKTree:
    """Burkhard-Keller tree of integers under the Hamming distance."""

    def __init__(self):
        self.values: list[int] = []
        self.kids: list[dict[int, int]] = []

    def add(self, x: int) -> None:
        self.values.append(x)
        self.kids.append({})
        new = len(self.values) - 1
        at = 0
        while at != new:
            at = self.kids[at].setdefault((self.values[at] ^ x).bit_count(), new)

    def within(self, x: int, radius: int) -> Iterator[int]:
        """Positions of the values at most ``radius`` bits from ``x``."""
        stack = [0] if self.values else []
        while stack:
            i = stack.pop()
            d = (self.values[i] ^ x).bit_count()
            if d <= radius:
                yield i
            for edge, child in self.kids[i].items():
                if d - radius <= edge <= d + radius:
                    stack.append(child)


def _tree_links(radius: int):
    def link(left: pd.DataFrame, right: pd.DataFrame | None, _: int) -> pd.DataFrame:
        """A spanning forest of the links within a shard, or between two chunks of one."""
        mask = (1 << BITS) - 1
        own = left["code"].tolist()
        other = [] if right is None else right["code"].tolist()
        parent = {x: x for x in own + other}

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        tree = BKTree()
        for x in own:
            if right is None:
                for i in tree.within(x & mask, radius):
                    parent[find(x)] = find(own[i])
            tree.add(x & mask)
        for x in other:
            for i in tree.within(x & mask, radius):
                parent[find(x)] = find(own[i])
        pairs = [(x, find(x)) for x in parent if parent[x] != x]
        return pd.DataFrame(pairs, columns=["u", "v"], dtype="int64")
    return link


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _blocks(free: list[int], n: int) -> list[list[int]]:
    size, more = divmod(len(free), n)
    cuts = [i * size + min(i, more) for i in range(n + 1)]
    return [free[a:b] for a, b in zip(cuts, cuts[1:])]


def shard_masks(radius: int, splits: int) -> list[list[tuple[int, int, int]]]:
    """Per level (parent mask id, mask id, mask): one of radius + 1 blocks of the bits that the parent leaves free."""
    levels, ids = [], 0
    parents = [(-1, 0, list(range(BITS)))]
    for _ in range(splits + 1):
        level, after = [], []
        for pid, pmask, free in parents:
            for block in _blocks(free, radius + 1):
                mask = pmask | sum(1 << b for b in block)
                level.append((pid, ids, _signed(mask)))
                after.append((ids, mask, [b for b in free if b not in block]))
                ids += 1
        levels.append(level)
        parents = after
    return levels


def hamming_links(fps: DataFrame, radius: int = 4, shard: int = SHARD) -> DataFrame:
    """Edges (u, v) that connect all distinct ``fp`` at most ``radius`` bits apart: a spanning forest per shard."""
    spark = fps.sparkSession
    levels = shard_masks(radius, SPLITS)
    rows = fps.select(F.explode(F.array(*[F.struct(F.lit(i).alias("k1"), F.col("fp").bitwiseAND(F.lit(m)).alias("k2"))
                                          for _, i, m in levels[0]])).alias("k"), "fp").select("k.k1", "k.k2", "fp")
    ready = []
    for level in levels[1:]:
        counts = cut(rows.groupBy("k1", "k2").agg(F.count("*").alias("n")).where(F.col("n") > shard), "large-shards", True)
        if not counts.count():
            break
        large = rows.join(counts.select("k1", "k2"), ["k1", "k2"], "left_semi")
        ready.append(rows.join(counts.select("k1", "k2"), ["k1", "k2"], "left_anti"))
        masks = spark.createDataFrame(level, "k1 int, child int, mask long")  # at most (radius + 1) ** (SPLITS + 1) rows
        rows = large.join(F.broadcast(masks), "k1").select(
            F.col("child").alias("k1"), F.col("fp").bitwiseAND(F.col("mask")).alias("k2"), "fp")
    for r in ready:
        rows = rows.unionByName(r)
    rows = rows.select("k1", "k2", F.col("fp").alias("node"), F.col("fp").alias("code"))
    return candidate_groups(rows, _tree_links(radius), "u long, v long", shard)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, radius: int = 4,
                    seed: int = 42) -> DataFrame:
    """One row per document: (doc_id, fp signed long, component_id).

    component_id is the smallest id among the documents reachable by links, itself
    included.  Null, empty and blank texts have fingerprint zero and link like any
    other.  Null ids take part; a component of null ids only has a null id.
    Repeated rows stay repeated; other columns are not read.  Texts are read once;
    equal fingerprints are one node, so thousands of copies cost one row in the search.
    """
    fps = cut(fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", ["doc_id"],
                           shingle, seed), "fingerprints")
    found = fingerprint_components(fps, radius)
    least = found.groupBy("root").agg(F.min("lo").alias("component_id"))
    labels = found.join(least, "root").select("fp", "component_id")
    return fps.join(labels, "fp").select("doc_id", "fp", "component_id")


def fingerprint_components(fps: DataFrame, radius: int) -> DataFrame:
    """(fp, lo, root) of every distinct fp in ``fps`` (doc_id, fp): its smallest id and its component's smallest fp."""
    nodes = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("lo")), "nodes", True)
    roots = components(hamming_links(nodes.select("fp"), radius))
    return nodes.join(roots, nodes["fp"] == roots["node"], "left") \
        .select("fp", "lo", F.coalesce("root", "fp").alias("root"))


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, radius: int = 4,
               seed: int = 42) -> DataFrame:
    """``docs`` with one row of each near-duplicate component: the one with the smallest id, all columns as they were.

    Of rows that repeat that id any one stays; a row with a null id stays only where
    its component has no other.
    """
    rows = cut(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                           F.monotonically_increasing_id().alias("row")), "rows")
    source = rows.select("row", F.col("doc")[doc_id].alias("doc_id"), F.col("doc")[text].alias("text"))
    small = cut(fingerprints(source, "text", ["row", "doc_id"], shingle, seed), "fingerprints")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    first = small.join(fingerprint_components(small, radius), "fp").groupBy("root").agg(F.min(order).alias("first"))
    kept = rows.join(first.select("first.row"), "row", "left_semi")
    return kept.select(*[F.col("doc")[c].alias(c) for c in docs.columns])
