"""Importance resampling towards a target corpus with bit-sliced aggregation.

Features are all runs of one to three consecutive words, hashed into ``BUCKETS`` buckets.  A bucket's gain is
the rounded-down log ratio of its smoothed share in the target and in the corpus.  A document's bucket counts
become bit planes: plane p has a bit for each bucket, set where bit p of the count is set.  The gains are cut into
planes as well, those of positive and of negative gains apart.  The weight, the sum of gains over all features, is then

    sum over p, q of 2 ** (p + q) * (popcount(count_p AND positive_q) - popcount(count_p AND negative_q)),

exact in integers.  Documents are drawn without replacement by the largest weight plus Gumbel noise, which a keyed
hash of the id gives.
"""

from __future__ import annotations

import math
import re
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 10_000
#: Words of the longest feature.
ORDER = 3
#: A draw is floor(SHARE * N / 100) of the N documents of at least MIN_WORDS words.
SHARE = 5
MIN_WORDS = 20
SEED = 42
#: Documents whose planes are built together, and bytes of text that are split into words at once.
DOCS_AT_ONCE = 64
PIECE = 1 << 22

_WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
#: Appending up to so many bytes to a CRC is one table look-up for each of its four bytes.
_REACH = 64


def _crc_step() -> np.ndarray:
    """CRC-32 of each byte after no others: the table of the reflected polynomial."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, t >> 1 ^ np.uint32(0xEDB88320), t >> 1)
    return t


class Crc:
    """CRC-32 of joined strings from those of their parts, for arrays of them."""

    def __init__(self):
        self.step = _crc_step()
        shifted = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
        tables = [shifted]
        for _ in range(_REACH):  # appending a zero byte is linear: each of the four bytes has a table
            shifted = self.step[shifted & 255] ^ shifted >> np.uint32(8)
            tables.append(shifted)
        self.tables = np.stack(tables, axis=1).reshape(4, -1)

    def shift(self, crc: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The CRC carried over ``n`` further bytes, before theirs is added."""
        out, left = crc, n
        while True:
            now = np.minimum(left, _REACH)
            at = now.astype(np.int64) << 8
            out = (self.tables[0][at | (out & 255)] ^ self.tables[1][at | (out >> np.uint32(8) & 255)]
                   ^ self.tables[2][at | (out >> np.uint32(16) & 255)] ^ self.tables[3][at | out >> np.uint32(24)])
            left = left - now
            if not left.any():
                return out

    def space(self, crc: np.ndarray) -> np.ndarray:
        """The CRC with one space appended."""
        inner = ~crc
        return ~(self.step[(inner ^ 0x20) & 255] ^ inner >> np.uint32(8))


def _words(text: bytes, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """CRC-32 and length in bytes of each word; the text is split piece by piece, at bytes that no word holds."""
    crcs, sizes, at = [], [], 0
    while at < len(text):
        end = at + piece
        if end < len(text):  # a word that is cut starts the next piece
            tail = re.search(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]*\Z", text[at:end].lower())
            end = at + tail.start() if tail.start() else _word_end(text, end)
        found = _WORD.findall(text[at:end].lower())
        crcs.append(np.fromiter(map(zlib.crc32, found), np.uint32, len(found)))
        sizes.append(np.fromiter(map(len, found), np.int32, len(found)))
        at = end
    if len(crcs) == 1:
        return crcs[0], sizes[0]
    return (np.concatenate(crcs), np.concatenate(sizes)) if crcs else (np.empty(0, np.uint32), np.empty(0, np.int32))


def _word_end(text: bytes, at: int) -> int:
    after = re.compile(rb"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]").search(text, at)
    return after.start() if after else len(text)


class Features:
    """Bucket counts of texts."""

    def __init__(self, order: int = ORDER, buckets: int = BUCKETS):
        self.crc, self.order, self.buckets = Crc(), order, buckets

    def of(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text index, bucket) of every feature, and the number of words of each text."""
        words = [_words(t or b"") for t in texts]
        n_words = np.array([len(c) for c, _ in words], np.int64)
        crc = np.concatenate([c for c, _ in words])
        size = np.concatenate([s for _, s in words])
        doc = np.repeat(np.arange(len(texts)), n_words)
        docs, found, run = [doc], [crc], crc
        for n in range(1, self.order):  # each run is the shorter one, a space and the next word
            run = self.crc.shift(self.crc.space(run[:-1]), size[n:]) ^ crc[n:] if len(run) > 1 else run[:0]
            whole = doc[:len(run)] == doc[n:] if len(run) else np.empty(0, bool)
            docs.append(doc[:len(run)][whole])
            found.append(run[whole])
        return np.concatenate(docs), (np.concatenate(found) % np.uint32(self.buckets)).astype(np.int64), n_words


def planes(counts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each bit of the counts (rows x buckets): (rows that have it set anywhere, their packed planes)."""
    out, most, p = [], counts.max(axis=1, initial=0), 0
    while (rows := np.flatnonzero(most >> p)).size:
        out.append((rows, _packed(counts[rows] >> p & 1)))
        p += 1
    return out


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    packed = np.packbits(bits.astype(bool), axis=1)
    return np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view(np.uint64)


def gain_planes(gains: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
    """(sign, bit, plane) of the magnitudes of the gains, positive and negative ones apart."""
    out = []
    for sign, part in ((1, np.maximum(gains, 0)), (-1, np.maximum(-gains, 0))):
        for q in range(int(part.max(initial=0)).bit_length()):
            out.append((sign, q, _packed((part >> q & 1)[None, :])[0]))
    return out


def weigh(counts: np.ndarray, sliced: list[tuple[int, int, np.ndarray]]) -> list[int]:
    """The weight of each row of counts, from popcounts of plane pairs."""
    weights = np.zeros(len(counts), np.int64)
    for p, (rows, plane) in enumerate(planes(counts)):
        for sign, q, gain in sliced:
            ones = np.bitwise_count(plane & gain).sum(axis=1, dtype=np.int64)
            weights[rows] += sign * (ones << (p + q))
    return weights.tolist()


def _slices(batches: Iterator[pa.RecordBatch], column: int):
    """(batch, first row, texts) of a few documents at a time."""
    for b in batches:
        values = b.column(column)
        for at in range(0, b.num_rows, DOCS_AT_ONCE):
            yield b, at, values.slice(at, DOCS_AT_ONCE).to_pylist()


def count_buckets(order: int, buckets: int):
    """Texts to (bucket, n), summed over each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Features(order, buckets), np.zeros(buckets, np.int64)
        for _, _, texts in _slices(batches, 0):
            total += np.bincount(features.of(texts)[1], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])
    return run


def bucket_counts(df: DataFrame, text: str, order: int = ORDER, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over all texts; at most ``buckets`` numbers reach the driver."""
    counts = df.select(F.col(text).cast("binary")).mapInArrow(count_buckets(order, buckets), "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for r in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the ratio of smoothed shares, in doubles."""
    whole, aim, k = float(corpus.sum()), float(target.sum()), len(corpus)
    return np.array([math.floor(1000 * math.log((t + 1.0) * (whole + k) / ((s + 1.0) * (aim + k))))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def weigh_texts(gains: np.ndarray, order: int = ORDER):
    """(id, hash, text) to (id, hash, n_words, n_features, weight, noise)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, sliced, buckets = Features(order, len(gains)), gain_planes(gains), len(gains)
        for b, at, texts in _slices(batches, 2):
            doc, bucket, n_words = features.of(texts)
            counts = np.bincount(doc * buckets + bucket, minlength=len(texts) * buckets).reshape(len(texts), buckets)
            hashes = b.column(1).slice(at, len(texts))
            noise = [math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))) for h in hashes.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(at, len(texts)), pa.array(n_words), pa.array(counts.sum(axis=1)),
                 pa.array(weigh(counts, sliced), pa.int64()), pa.array(noise, pa.int64())],
                ["doc_id", "n_words", "n_features", "weight", "noise"])
    return run


def ranked(scored: DataFrame, drawable: Column, score: str, tie: str, share: int) -> DataFrame:
    """``scored`` with the column rank: 1, 2, ... for the floor(share * N / 100) drawable rows of the highest scores,
    else null.  Rows are dealt by ranges of the score and counted along the ranges; no task holds them all."""
    spark = scored.sparkSession
    keyed = cut(scored.withColumn("_row", F.monotonically_increasing_id()), "scored")  # equal rows keep apart
    order = [F.desc("_in"), F.desc(score), F.col(tie).asc_nulls_last(), F.col("_row")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = keyed.withColumn("_in", F.coalesce(drawable, F.lit(False)))
    place = F.monotonically_increasing_id()
    dealt = cut(keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                .withColumn("_part", F.shiftright(place, 33)).withColumn("_at", place.bitwiseAND(F.lit((1 << 33) - 1))), "ranges")
    sizes = {r["_part"]: r["n"] for r in dealt.groupBy("_part").agg(F.count("*").alias("n")).collect()}  # a row for each range
    before, rows = 0, []
    for p in sorted(sizes):
        rows.append((p, before))
        before += sizes[p]
    drawn = dealt.where("_in").count() * share // 100
    begins = F.broadcast(spark.createDataFrame(rows, "_part long, _before long"))
    at = F.col("_before") + F.col("_at") + 1
    return dealt.join(begins, "_part").withColumn("rank", F.when(F.col("_in") & (at <= drawn), at)) \
        .drop("_part", "_at", "_before", "_in", "_row")


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
             share: int = SHARE, min_words: int = MIN_WORDS, seed: int = SEED, order: int = ORDER,
             buckets: int = BUCKETS) -> DataFrame:
    """One row per document: (doc_id, n_words, n_features, weight, score, rank), rank null if it is not drawn.

    Null and empty texts have no words, no features and weight 0.  Repeated rows are documents of their own; a null id
    is hashed as an empty one, and ties of the score go to the smaller id, null ids last, then in any order.  Empty
    corpora and targets give gains from the smoothing alone.  Texts of any length are read whole.  Columns other
    than those named are not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    gains = bucket_gains(bucket_counts(rows, "text", order, buckets), bucket_counts(target, target_text, order, buckets))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    kind = docs.schema[doc_id].dataType.simpleString()
    weighed = rows.select("doc_id", drawn.alias("h"), F.col("text").cast("binary").alias("text")) \
        .mapInArrow(weigh_texts(gains, order), f"doc_id {kind}, n_words long, n_features long, weight long, noise long")
    scored = weighed.select("doc_id", "n_words", "n_features", "weight", (F.col("weight") + F.col("noise")).alias("score"))
    return ranked(scored, F.col("n_words") >= min_words, "score", "doc_id", share)
