"""Token-id output packed by best-fit-decreasing.

Documents are cut losslessly into pieces of at most one sequence; the pieces of
a shard (a bounded run of a task's documents) are placed longest first into the
open sequence that they fill best, which a segment tree over the remaining
capacities finds.  A row holds a sequence's padded id matrix row, cumulative
segment lengths and position ids that start again at each segment.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packing import END_ID, blocks
from .wordcache import CACHE, default_path, word_encoder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Ids packed together; a shard ends with the document that reaches it.
SHARD_IDS = 4_000_000


class CapacityTree:
    """Open bins by remaining capacity; ``best(n)`` takes one with the least capacity of at least n, or -1."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(self.size)]

    def put(self, remaining: int, which: int) -> None:
        self.bins[remaining].append(which)
        self._add(remaining, 1)

    def _add(self, leaf: int, by: int) -> None:
        i = leaf + self.size
        while i:
            self.count[i] += by
            i >>= 1

    def best(self, n: int) -> tuple[int, int]:
        i = n + self.size
        while not self.count[i]:  # climb to the first subtree on the right that holds a bin
            while i & 1:
                i >>= 1
            if not i:
                return -1, -1
            i += 1
            if i & (i - 1) == 0:  # past the last leaf of this level
                return -1, -1
        while i < self.size:
            i *= 2
            if not self.count[i]:
                i += 1
        leaf = i - self.size
        which = self.bins[leaf].pop()
        self._add(leaf, -1)
        return which, leaf


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of piece positions; each bin's lengths sum to at most ``capacity``."""
    tree, bins = CapacityTree(capacity), []
    for p in sorted(range(len(lengths)), key=lambda p: (-lengths[p], p)):
        which, room = tree.best(lengths[p])
        if which < 0:
            which, room = len(bins), capacity
            bins.append([])
        bins[which].append(p)
        tree.put(room - lengths[p], which)
    return bins


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = 2048, end_id: int = END_ID,
         pad_id: int = 0, tokenizer: str | None = None, shard_ids: int = SHARD_IDS,
         cache: int = CACHE) -> DataFrame:
    """One row per packed sequence: sequence_id, ids, cu_seqlens, position_ids, segments.

    ids and position_ids are ``capacity`` little-endian uint32 each (padding:
    pad_id, position 0); cu_seqlens are the segment borders from 0; segments hold
    (doc_id, start, length, doc_tokens) in that order.  Every row of ``docs`` is a
    document; null and empty texts are the end id alone.  Other columns are not read.
    """
    path = tokenizer or default_path()
    end = np.array([end_id], "<u4").tobytes()
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    schema = (f"ids binary, cu_seqlens array<int>, position_ids binary, "
              f"segments array<struct<doc_id:{kind},start:long,length:long,doc_tokens:long>>")

    def packed(held: list, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        pieces = [(d, at, ids[4 * at:4 * (at + capacity)], len(ids) // 4)
                  for d, ids in held for at in range(0, len(ids) // 4, capacity)]
        bins = best_fit_decreasing([len(p[2]) // 4 for p in pieces], capacity)
        seg = pa.struct([("doc_id", id_type), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64())])
        pad = np.array([pad_id], "<u4").tobytes()
        for at in range(0, len(bins), 512):
            ids, cu, pos, segs = [], [], [], []
            for b in bins[at:at + 512]:
                sizes = [len(pieces[p][2]) // 4 for p in b]
                row = b"".join(pieces[p][2] for p in b)
                ids.append(row + pad * (capacity - len(row) // 4))
                cu.append([0, *np.cumsum(sizes).tolist()])
                resets = np.concatenate([np.arange(n, dtype="<u4") for n in sizes])
                pos.append(resets.tobytes() + bytes(4 * (capacity - len(resets))))
                segs.append([{"doc_id": pieces[p][0], "start": pieces[p][1], "length": n, "doc_tokens": pieces[p][3]}
                             for p, n in zip(b, sizes)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.binary()), pa.array(cu, pa.list_(pa.int32())), pa.array(pos, pa.binary()),
                 pa.array(segs, pa.list_(seg))], ["ids", "cu_seqlens", "position_ids", "segments"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_encoder(path, cache)
        held, size, id_type = [], 0, pa.int64()
        for b in batches:
            id_type = b.schema.field(0).type
            for first, texts in blocks(b.column(1)):
                for i, ids in enumerate(encode(texts), first):
                    held.append((b.column(0)[i].as_py(), ids + end))
                    size += len(ids) // 4 + 1
                    if size >= shard_ids:
                        yield from packed(held, id_type)
                        held, size = [], 0
        if held:
            yield from packed(held, id_type)

    return source.mapInArrow(run, schema).withColumn("sequence_id", F.monotonically_increasing_id())


def segments(packed: DataFrame) -> DataFrame:
    """One row per segment of packed sequences, with the CRC-32 of its ids as they lie in the matrix row."""
    each = packed.select("sequence_id", "ids", "cu_seqlens", F.posexplode("segments").alias("k", "s"))
    offset = F.col("cu_seqlens")[F.col("k")]
    ids = F.expr("substring(ids, 4 * offset + 1, 4 * cast(s.length as int))")
    return each.withColumn("offset", offset).select(
        "s.doc_id", "s.start", "s.length", F.crc32(ids).alias("ids_crc32"), "s.doc_tokens", "sequence_id",
        F.col("offset").cast("long").alias("offset"))


def write_matrices(docs: DataFrame, path: str, **options) -> None:
    """Write the packed sequences to ``path`` as Parquet (id matrix rows, cu_seqlens, position ids, segments)."""
    pack(docs, **options).write.parquet(path)
