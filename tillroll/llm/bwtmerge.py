"""Removal of repeated byte strings by merged Burrows-Wheeler transforms.

A byte is removed when a string of ``length`` bytes that covers it also starts anywhere else in
the corpus.  Equal strings have equal anchors: the leftmost ``SEED``-byte piece with the least hash
in them.  So all strings that can be equal meet under the hash of their anchor:

1. every text is cut into contexts, the runs of string starts that share an anchor; contexts whose
   anchor stands nowhere else in the corpus hold no repeated string;
2. equal contexts are one context with a multiplicity, and only distinct ones carry their text;
3. the contexts of whole anchors are dealt into shards.  Each shard's suffixes are sorted once, which
   gives its transform; shards are merged by refining their interleave: it starts as the merge by the
   first eight bytes, and each round compares twice as many, the class of a suffix being refined by
   the class of the suffix that follows it.  A shard's own order never changes, so a round merges
   sorted runs and sorts no suffix again.  Neighbours in one class after the last round have a
   common prefix of ``length`` bytes: their class is a repeated interval if it holds two starts;
4. the repeated starts go back to every place where their context stands.

An anchor with more context text than ``GROUP_BYTES`` is split by where its strings begin: the strings of
half the starts share a longer piece around the anchor, whose hash is the key of a smaller group.  At a
single start that piece is the string itself, so groups end within the bound.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .common import cut

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTH = 200
#: Bytes of an anchor.
SEED = 32
#: Texts are scanned in pieces of about so many bytes, with an overlap.
PIECE = 1 << 18
#: Context text of one merge, of one shard in it, and the most that one anchor may bring.
BLOCK_BYTES = 1 << 19
SHARD_BYTES = 1 << 17
GROUP_BYTES = 4 << 20
#: Keys of more rows than this, and than a HOT_KEYS-th of all, are joined by broadcast: at most HOT_KEYS of them.
HOT_ROWS = 20_000
HOT_KEYS = 50_000

_MULTIPLY = np.uint64(0xD6E8FEB86659FD93)  # any odd number with well-mixed bits
_POSITION = np.uint64((1 << 24) - 1)


def seed_hashes(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit polynomial hash of each ``seed`` bytes (a power of two) of ``x``."""
    h = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    base, w = _MULTIPLY, 1
    while w < seed:
        h = h[:-w] * base + h[w:]
        base, w = base * base, 2 * w
    h ^= h >> np.uint64(32)
    h *= _MULTIPLY
    h ^= h >> np.uint64(29)
    return h


def anchors(x: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each piece of ``seed`` bytes, place of the anchor of each string of ``length`` bytes)."""
    with np.errstate(over="ignore"):
        h = seed_hashes(x, seed)
    least = (h & ~_POSITION) | np.arange(len(h), dtype=np.uint64)  # ties: the leftmost
    w, size = 1, length - seed + 1
    while 2 * w <= size:
        least, w = np.minimum(least[:-w], least[w:]), 2 * w
    if size > w:
        least = np.minimum(least[:w - size], least[size - w:])
    return h, (least & _POSITION).astype(np.int64)


def _scan(texts: list[bytes], owners: list[int], starts: list[int], length: int, seed: int):
    """(key, context hash, owner, packed place) of the contexts of whole pieces of text."""
    whole = b"".join(texts)
    if len(whole) < length:
        return None
    x = np.frombuffer(whole, np.uint8)
    h, a = anchors(x, length, seed)
    ends = np.cumsum([len(t) for t in texts])
    doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts])[:len(a)]
    begin = np.flatnonzero(np.arange(len(a)) + length <= ends[doc])  # the strings that lie in one text
    if not len(begin):
        return None
    first = np.flatnonzero(np.r_[True, (a[begin[1:]] != a[begin[:-1]]) | (begin[1:] != begin[:-1] + 1)])
    last = np.r_[first[1:], len(begin)] - 1
    s, e, at = begin[first], begin[last], a[begin[first]]
    context = np.fromiter((xxhash.xxh3_64_intdigest(whole[i:j]) for i, j in zip(s.tolist(), (e + length).tolist())),
                          np.uint64, len(s))
    d = doc[s]
    offset = (np.asarray(starts) - np.r_[0, ends[:-1]])[d]
    # the place: start of the context in its text, number of strings less one, anchor after the start
    place = (s + offset) << 20 | (e - s) << 10 | (at - s)
    return pa.RecordBatch.from_arrays(
        [pa.array(h[at].view(np.int64)), pa.array(context.view(np.int64)), pa.array(np.asarray(owners, np.int64)[d]),
         pa.array(place)], ["key", "c", "t", "place"])


def scan_contexts(length: int, seed: int, piece: int = PIECE):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, owners, starts, held = [], [], [], 0
        for b in batches:
            for t, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for i in range(0, max(1, len(text) - length + 1), piece):
                    part = text[i:i + piece + length - 1]
                    texts.append(part)
                    owners.append(t)
                    starts.append(i)
                    held += len(part)
                    if held >= piece:
                        found = _scan(texts, owners, starts, length, seed)
                        if found is not None:
                            yield found
                        texts, owners, starts, held = [], [], [], 0
        if texts:
            found = _scan(texts, owners, starts, length, seed)
            if found is not None:
                yield found
    return run


def _depths(length: int) -> list[int]:
    """How far each round looks ahead: 8, 16, ... and the rest to ``length``."""
    steps, depth = [], 8
    while depth < length:
        steps.append(min(depth, length - depth))
        depth += steps[-1]
    return steps


def _packed(x: np.ndarray, n: int) -> np.ndarray:
    """The first eight bytes of each suffix as a number (``x`` has at least eight more than ``n`` bytes)."""
    key = x[:n].astype(np.uint64)
    for i in range(1, 8):
        key = key << np.uint64(8) | x[i:n + i]
    return key


def _classes(sorted_keys: np.ndarray) -> np.ndarray:
    """For each place of an order, one more than the place where its class begins."""
    new = np.empty(len(sorted_keys), bool)
    new[:1] = True
    np.not_equal(sorted_keys[1:], sorted_keys[:-1], out=new[1:])
    begins = np.flatnonzero(new)
    return np.repeat(begins.astype(np.int32) + 1, np.diff(begins, append=len(new)))


def _refine(order: np.ndarray, rank: np.ndarray, open_: np.ndarray | None, step: int, kind: str | None) -> np.ndarray:
    """Order the members of each class by the class of the suffix ``step`` further, in place.  ``open_``: the places of
    the order in classes of two or more, None if not known; returned for the next round.  ``rank`` has zeros behind."""
    if open_ is None:
        mine = rank[order]
        open_ = np.flatnonzero(_several(mine))
    if not len(open_):
        return open_
    suffix = order[open_]
    key = rank[suffix].astype(np.int64)
    key <<= 32
    key |= rank[suffix + step]
    by = np.argsort(key, kind=kind)
    key, suffix = key[by], suffix[by]
    order[open_] = suffix
    at = _classes(key)
    rank[suffix] = open_[at - 1] + 1
    return open_[_several(at)]


def _several(classes: np.ndarray) -> np.ndarray:
    """Which places of an order share their class with a neighbour."""
    same = classes[1:] == classes[:-1]
    out = np.zeros(len(classes), bool)
    out[1:] = same
    out[:-1] |= same
    return out


def _ranked(order: np.ndarray, sorted_keys: np.ndarray, length: int) -> np.ndarray:
    rank = np.zeros(len(order) + length, np.int32)
    rank[order] = _classes(sorted_keys)
    return rank


def shard_order(x: np.ndarray, n: int, length: int) -> np.ndarray:
    """The suffixes of ``x[:n]`` in the order of their first ``length`` bytes.  The shard's transform is the
    byte before each of them."""
    key = _packed(x, n)
    order = np.argsort(key).astype(np.int32)
    rank, open_ = _ranked(order, key[order], length), None
    for step in _depths(length):
        open_ = _refine(order, rank, open_, step, None)
    return order


def merge(shards: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Merge the shards' transforms.  Returns (order of all suffixes by their first ``length`` bytes, class of each
    suffix): equal classes have a common prefix of ``length`` bytes.  Suffixes are counted through the shards,
    and those that end before ``length`` bytes are compared with zeros or the next shard behind them."""
    n = sum(map(len, shards))
    x = np.frombuffer(b"".join([*shards, bytes(8)]), np.uint8)
    base, orders = 0, []
    for s in shards:  # each sorted by itself
        orders.append(shard_order(np.frombuffer(s + bytes(8), np.uint8), len(s), length) + np.int32(base))
        base += len(s)
    runs = np.concatenate(orders)
    key = _packed(x, n)[runs]
    by = np.argsort(key, kind="stable")  # the interleave by eight bytes; stable sorts merge sorted runs
    order = runs[by]
    rank, open_ = _ranked(order, key[by], length), None
    for step in _depths(length):
        open_ = _refine(order, rank, open_, step, "stable")
    return order, rank[:n]


def _repeated(contexts: list[bytes], counts: np.ndarray, length: int, shard_bytes: int):
    """For each context, the runs (first, last) of its string starts whose string stands twice or more."""
    shards, held, size = [], [], 0
    for c in contexts:
        held.append(c)
        size += len(c)
        if size >= shard_bytes:
            shards.append(b"".join(held))
            held, size = [], 0
    if held:
        shards.append(b"".join(held))
    order, rank = merge(shards, length)
    sizes = np.array([len(c) for c in contexts])
    starts = np.cumsum(sizes) - sizes
    n = sizes - length + 1
    owner = np.repeat(np.arange(len(contexts)), n)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    cls = rank[starts[owner] + inside]
    times = np.bincount(cls, weights=counts[owner], minlength=1)
    again = times[cls] >= 2  # classes with two starts or more: repeated intervals
    edge = np.r_[True, (owner[1:] != owner[:-1]) | (again[1:] != again[:-1])]
    first = np.flatnonzero(edge)
    last = np.r_[first[1:], len(owner)] - 1
    keep = again[first]
    return owner[first[keep]], inside[first[keep]], inside[last[keep]]


def find_repeated(length: int, block_bytes: int, shard_bytes: int):
    """Rows sorted by key: (key, c, n, context) to (key, c, n, runs)."""
    def flush(rows):
        keys, cs, ns, contexts = zip(*rows)
        owner, lo, hi = _repeated(list(contexts), np.array(ns, np.float64), length, shard_bytes)
        if not len(owner):
            return None
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        cuts = pa.array(np.r_[first, len(owner)].astype(np.int32))
        own = owner[first]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.array(keys, np.int64)[own]), pa.array(np.array(cs, np.int64)[own]), pa.array(np.array(ns, np.int64)[own]),
             pa.ListArray.from_arrays(cuts, pa.array(lo.astype(np.int32))),
             pa.ListArray.from_arrays(cuts, pa.array(hi.astype(np.int32)))], ["key", "c", "n", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for b in batches:
            for row in zip(*(b.column(i).to_pylist() for i in range(4))):
                if held >= block_bytes and row[0] != rows[-1][0]:
                    found = flush(rows)
                    if found is not None:
                        yield found
                    rows, held = [], 0
                rows.append(row)
                held += len(row[3])
        if rows:
            found = flush(rows)
            if found is not None:
                yield found
    return run


def _slice(length: int):
    """(text, [(key, c, n, place)]) to (key, c, n, at, context)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, cs, ns, ats, out, held = [], [], [], [], [], 0
            for text, wanted in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for w in wanted:
                    s, more, at = w["place"] >> 20, w["place"] >> 10 & 1023, w["place"] & 1023
                    keys.append(w["key"])
                    cs.append(w["c"])
                    ns.append(w["n"])
                    ats.append(at)
                    out.append(text[s:s + more + length])
                    held += more + length
                    if held > 4 << 20:
                        yield _context_batch(keys, cs, ns, ats, out)
                        keys, cs, ns, ats, out, held = [], [], [], [], [], 0
            if keys:
                yield _context_batch(keys, cs, ns, ats, out)
    return run


def _context_batch(keys, cs, ns, ats, contexts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(cs, pa.int64()), pa.array(ns, pa.int64()),
                                       pa.array(ats, pa.int32()), pa.array(contexts, pa.binary())],
                                      ["key", "c", "n", "at", "context"])


def _span(length: int, seed: int) -> int:
    """The distances of an anchor from the start of its strings, rounded up to a power of two."""
    span = 1
    while span < length - seed + 1:
        span *= 2
    return span


def _halves(size: int, length: int):
    """Contexts of a crowded key to their parts whose strings begin [lo, lo + size) bytes before the anchor, with the
    piece that all those strings share as the key: (key, c, s, key2, c2, n, at, context), the part beginning at s."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for key, c, n, at, text in zip(*(b.column(i).to_pylist() for i in range(5))):
                least = at - (len(text) - length)
                for lo in range(least // size * size, at + 1, size):
                    near, far = max(lo, least), min(lo + size - 1, at)
                    part = text[at - far:at - near + length]
                    shared = text[at - lo:at - lo - size + 1 + length]
                    rows.append((key, c, at - far, xxhash.xxh3_64_intdigest(shared + lo.to_bytes(4, "little")) - (1 << 63),
                                 xxhash.xxh3_64_intdigest(part) - (1 << 63), n, far, part))
            if rows:
                columns = zip(*rows)
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(columns, kinds)],
                                                 ["key", "c", "s", "key2", "c2", "n", "at", "context"])
    return run


def _removed(length: int):
    """(doc_id, text, [(lo, hi)] of repeated starts) to what is removed and what is kept."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            starts, ends, cuts, kept = [], [], [0], []
            for text, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                at, left = 0, []
                for lo, hi in sorted((s["lo"], s["hi"]) for s in spans or ()):
                    if ends and len(ends) > cuts[-1] and lo <= ends[-1]:
                        ends[-1] = max(ends[-1], hi + length)
                    else:
                        starts.append(lo)
                        ends.append(hi + length)
                for s, e in zip(starts[cuts[-1]:], ends[cuts[-1]:]):
                    left.append(text[at:s])
                    at = e
                left.append(text[at:])
                cuts.append(len(ends))
                kept.append(b"".join(left))
            pairs = pa.StructArray.from_arrays([pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], ["start", "end"])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pairs), pa.array(kept, pa.binary())],
                ["doc_id", "spans", "kept"])
    return run


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with a number ``t``, written once as a table bucketed by it: later joins on ``t`` move no text."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"texts_{uuid.uuid4().hex}"
    (rows.withColumn("t", F.monotonically_increasing_id()).repartition(parts, "t").write.bucketBy(parts, "t")
     .option("path", f"{checkpoint_dir(spark).rstrip('/')}/{name}").option("compression", "zstd").saveAsTable(name))
    return spark.table(name)


def _counted_join(left: DataFrame, right: DataFrame, on: list[str], by: list[str]) -> DataFrame:
    """``left`` joined to ``right``, whose column n counts the rows of ``left`` that each of its keys has.  Keys of
    many rows are dealt out by a hash of ``by``; at most HOT_KEYS keys are, so their list is broadcast."""
    total = right.agg(F.sum("n")).first()[0] or 0
    most = max(HOT_ROWS, total // HOT_KEYS)
    salts = F.ceil(F.col("n") / most).cast("int")
    heavy = right.where(F.col("n") > most).select(*on, salts.alias("salts"))
    spread = right.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("n")
    salted = left.join(F.broadcast(heavy), on, "left") \
        .withColumn("salt", F.pmod(F.xxhash64(*by), F.coalesce("salts", F.lit(1))).cast("int")).drop("salts")
    return salted.join(spread, [*on, "salt"]).drop("salt")


def _found(contexts: DataFrame, length: int, seed: int, size: int, group_bytes: int) -> DataFrame:
    """(key, c, n, runs) of the contexts (key, c, n, at, context) that hold repeated starts."""
    merged = find_repeated(length, BLOCK_BYTES, SHARD_BYTES)

    def whole(rows: DataFrame) -> DataFrame:
        dealt = rows.select("key", "c", "n", "context").repartition("key").sortWithinPartitions("key")
        return dealt.mapInArrow(merged, "key long, c long, n long, lo array<int>, hi array<int>") \
            .select("key", "c", "n", F.arrays_zip("lo", "hi").alias("runs"))

    if size < 1:
        return whole(contexts)
    crowded = cut(contexts.groupBy("key").agg(F.sum(F.length("context")).alias("b")).where(F.col("b") > group_bytes)
                  .select("key"), "crowded-anchors", True)
    n = crowded.count()
    if not n:
        return whole(contexts)
    few = F.broadcast(crowded) if n <= HOT_KEYS else crowded
    parts = cut(contexts.join(few, "key", "left_semi").select("key", "c", "n", "at", "context")
                .mapInArrow(_halves(size, length), "key long, c long, s int, key2 long, c2 long, n long, at int, context binary"),
                "context-parts")
    smaller = parts.groupBy("key2", "c2").agg(F.sum("n").alias("n"), F.count("*").alias("m"), F.min("at").alias("at"),
                                              F.min("context").alias("context"))
    smaller = cut(smaller.withColumnsRenamed({"key2": "key", "c2": "c"}), "contexts", True)
    found = _found(smaller.drop("m"), length, seed, size // 2, group_bytes).join(smaller.select("key", "c", "m"), ["key", "c"]) \
        .select(F.col("key").alias("key2"), F.col("c").alias("c2"), F.col("m").alias("n"), "runs")
    found = cut(found, "repeated-parts", True)
    back = _counted_join(parts.select("key", "c", "s", F.col("n").alias("times"), "key2", "c2"), found, ["key2", "c2"], ["key", "c"])
    back = back.groupBy("key", "c").agg(F.min("times").alias("n"), F.flatten(F.collect_list(F.transform(
        "runs", lambda r: F.struct((r["lo"] + F.col("s")).alias("lo"), (r["hi"] + F.col("s")).alias("hi"))))).alias("runs"))
    return whole(contexts.join(few, "key", "left_anti")).unionByName(back)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, seed: int = SEED,
                   group_bytes: int = GROUP_BYTES) -> DataFrame:
    """One row per document: (doc_id, n_bytes, n_removed, n_spans, spans, kept).

    ``spans`` are the maximal removed runs (start, end exclusive, in bytes of the UTF-8 text), ``kept`` the other bytes in
    order; a cut may part the bytes of a letter.  Every row is a document of its own, also with a repeated or null id; equal
    texts repeat each other.  Null and empty texts have no bytes; texts shorter than ``length`` lose none.  Texts of any
    length are read whole.  Strings within a document count as well, overlapping ones too.  Columns other than the two
    named are not read.  ``seed`` is a power of two of at most ``length``.
    """
    if not (8 <= seed <= length < 1024) or seed & (seed - 1):
        raise ValueError("seed must be a power of two from 8 to length, and length below 1024")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    texts = _numbered(rows)
    places = cut(texts.select("t", "text").mapInArrow(scan_contexts(length, seed), "key long, c long, t long, place long"), "contexts")
    shared = cut(places.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "anchors", True)
    wanted = cut(_counted_join(places, shared, ["key"], ["t", "place"]), "places")
    lists = wanted.groupBy("key", "c").agg(F.count("*").alias("n"), F.min(F.struct("t", "place")).alias("at")) \
        .groupBy(F.col("at.t").alias("t")).agg(F.collect_list(F.struct("key", "c", "n", "at.place")).alias("wanted"))
    contexts = cut(texts.join(lists, "t").select("text", "wanted")
                   .mapInArrow(_slice(length), "key long, c long, n long, at int, context binary"), "contexts")
    found = cut(_found(contexts, length, seed, _span(length, seed) // 2, group_bytes), "repeats")
    spans = _counted_join(wanted, found, ["key", "c"], ["t", "place"])
    begin = F.shiftright("place", 20)
    per_text = spans.select("t", F.transform("runs", lambda r: F.struct((begin + r["lo"]).alias("lo"), (begin + r["hi"]).alias("hi")))
                            .alias("spans")).groupBy("t").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    kind = docs.schema[doc_id].dataType.simpleString()
    out = texts.join(per_text, "t", "left").select("doc_id", "text", "spans") \
        .mapInArrow(_removed(length), f"doc_id {kind}, spans array<struct<start:bigint,end:bigint>>, kept binary")
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", (F.length("kept") + removed).cast("long").alias("n_bytes"), removed.alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), "spans", "kept")
