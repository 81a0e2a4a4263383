"""Packing by power-of-two decomposition.

A document's ids, with the end id, are cut into full sequences and then into
pieces of the binary digits of what is left.  Every piece fills a sequence of
its own length, equal lengths form a bucket, no sequence holds two documents
and none is padded.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .wordcache import CACHE, default_path, word_encoder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

END_ID = 1
#: Texts encoded at a time: so many characters, or one document.
BLOCK = 4_000_000


def binary_pieces(n: int, longest: int = 2048) -> list[int]:
    """Lengths of the pieces of ``n`` ids: full ones, then the binary digits of the rest, longest first.

    >>> binary_pieces(4096 + 1024 + 5)
    [2048, 2048, 1024, 4, 1]
    """
    if longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    full, rest = divmod(n, longest)
    return [longest] * full + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def blocks(texts: pa.Array, limit: int = BLOCK) -> Iterator[tuple[int, list[bytes | None]]]:
    """(first row, texts) of consecutive rows of about ``limit`` bytes; memory of earlier batches goes back to the system."""
    pa.default_memory_pool().release_unused()
    at, size, held = 0, 0, []
    for i, t in enumerate(texts):
        held.append(t.as_py())
        size += len(held[-1] or b"")
        if size >= limit:
            yield at, held
            at, size, held = i + 1, 0, []
    if held:
        yield at, held


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", longest: int = 2048, end_id: int = END_ID,
         tokenizer: str | None = None, with_ids: bool = False, cache: int = CACHE) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids].

    Every row of ``docs`` is a document, also one whose id is null or repeats; null
    and empty texts are the end id alone.  length is the bucket; ``ids`` are the
    piece's ids as little-endian uint32.  sequence_id is unique and offset 0, as a
    piece fills its sequence.  ``cache`` bounds a worker's known chunks.  Other columns are not read.  There is no shuffle.
    """
    path = tokenizer or default_path()
    end = np.array([end_id], "<u4").tobytes()
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
    if not with_ids:
        schema = schema.removesuffix(", ids binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_encoder(path, cache)
        for b in batches:
            for first, texts in blocks(b.column(1)):
                row, start, length, crc, total, parts = [], [], [], [], [], []
                for i, packed in enumerate(encode(texts), first):
                    packed += end
                    n, at = len(packed) // 4, 0
                    for size in binary_pieces(n, longest):
                        piece = packed[4 * at:4 * (at + size)]
                        row.append(i)
                        start.append(at)
                        length.append(size)
                        crc.append(zlib.crc32(piece))
                        total.append(n)
                        if with_ids:
                            parts.append(piece)
                        at += size
                columns = [b.column(0).take(pa.array(row, pa.int32()))]
                columns += [pa.array(x, pa.int64()) for x in (start, length, crc, total)]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    columns.append(pa.array(parts, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return source.mapInArrow(run, schema).withColumn("sequence_id", F.monotonically_increasing_id()) \
        .withColumn("offset", F.lit(0).cast("long"))


def write_buckets(docs: DataFrame, path: str, **options) -> None:
    """Write the pieces with their ids to ``path``, one folder per sequence length."""
    pack(docs, with_ids=True, **options).write.partitionBy("length").parquet(path)
