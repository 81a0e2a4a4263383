"""Language identification by prediction by partial matching.

Each language has a context tree over bytes: how often each byte followed each
context of 0 to ``order`` bytes in its training texts.  A byte is coded in the
longest context that the tree knows; if it never followed there, an escape is
paid (method C: as likely as the context's number of different successors) and
the context loses its oldest byte, down to equal odds for all bytes.  The
statistics are frozen, so a text's code length is a sum over its positions; the
language that codes the text in the fewest bits is predicted.
"""

from __future__ import annotations

import re
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .packing import blocks
from .wordcache import worker_store

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ORDER = 4
#: Bounds of the training sample: rows of each language (chosen by hash), and characters of a row; longer rows are not used.
ROWS_PER_LANGUAGE, LONGEST_ROW = 400, 50_000
#: Slots of a worker's table of known costs.
MEMO_BITS = 20
UNDETERMINED = "und"
LETTER = re.compile(r"[^\W\d_]")


def grams(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """(key of each position, first position of each text): the byte and the ``order`` bytes before it.

    A text is preceded by spaces.
    """
    pad = b" " * order
    flat = np.frombuffer(pad + pad.join(texts) if texts else pad, np.uint8).astype(np.int64)
    key = np.zeros(len(flat) - order, np.int64)
    for k in range(order + 1):
        key = (key << 8) | flat[k:len(flat) - order + k]
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes + order) - sizes - order
    own = np.zeros(len(key) + 1, np.int64)
    np.add.at(own, starts, 1)
    np.add.at(own, starts + sizes, -1)
    key = key[np.cumsum(own[:-1]) > 0]
    return key, np.cumsum(sizes) - sizes


@dataclass
class ContextTree:
    """Sorted (context, byte) keys with their bits, and sorted contexts with the bits of their escape, by order."""
    found: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    escape: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)

    @classmethod
    def of(cls, texts: list[bytes], order: int) -> "ContextTree":
        tree = cls()
        key, _ = grams(texts, order)
        for k in range(order + 1):
            pairs, n = np.unique(key & ((1 << 8 * (k + 1)) - 1), return_counts=True)
            contexts, first, kinds = np.unique(pairs >> 8, return_index=True, return_counts=True)
            total = np.add.reduceat(n, first) if len(n) else n
            tree.found.append((pairs, (np.repeat(np.log2(total + kinds), kinds) - np.log2(n)).astype(np.float32)))
            tree.escape.append((contexts, (np.log2(total + kinds) - np.log2(kinds)).astype(np.float32)))
        return tree

    def bits(self, key: np.ndarray) -> np.ndarray:
        """Code length of each position's byte after its context."""
        cost = np.zeros(len(key), np.float32)
        open_ = np.arange(len(key))
        for k in range(len(self.found) - 1, -1, -1):
            short = key[open_] & ((1 << 8 * (k + 1)) - 1)
            pairs, bits = self.found[k]
            at = np.minimum(np.searchsorted(pairs, short), max(len(pairs) - 1, 0))
            hit = pairs[at] == short if len(pairs) else np.zeros(len(short), bool)
            cost[open_[hit]] += bits[at[hit]]
            open_, short = open_[~hit], short[~hit] >> 8
            contexts, bits = self.escape[k]
            at = np.minimum(np.searchsorted(contexts, short), max(len(contexts) - 1, 0))
            known = contexts[at] == short if len(contexts) else np.zeros(len(short), bool)
            cost[open_[known]] += bits[at[known]]
        cost[open_] += 8
        return cost


@dataclass
class Model:
    languages: list[str]
    trees: list[ContextTree]
    order: int
    token: str

    def costs(self, key: np.ndarray) -> np.ndarray:
        """Bits of each position in each language (positions x languages), through the worker's table."""
        store = worker_store("ppm", self.token)
        if not store:
            store["key"] = np.full(1 << MEMO_BITS, -1, np.int64)
            store["cost"] = np.zeros((1 << MEMO_BITS, len(self.trees)), np.float32)
        slot = ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - MEMO_BITS)).view(np.int64)
        out = store["cost"][slot]
        missed = (store["key"][slot] != key).nonzero()[0]
        if len(missed):
            new, first, place = np.unique(key[missed], return_index=True, return_inverse=True)
            cost = np.stack([t.bits(new) for t in self.trees], axis=1)
            out[missed] = cost[place]
            store["key"][slot[missed[first]]] = new
            store["cost"][slot[missed[first]]] = cost
            # of keys that share a slot, the last one's pair is stored; both assignments keep the same one
        return out

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text in each language."""
        total = np.zeros((len(texts), len(self.trees)))
        filled = [i for i, t in enumerate(texts) if t]
        if filled:
            key, starts = grams([texts[i] for i in filled], self.order)
            total[filled] = np.add.reduceat(self.costs(key), starts, axis=0, dtype=np.float64)
        return total


def fit(rows: list[tuple[str, str]], order: int = ORDER) -> Model:
    """A tree per language from (text, language) rows."""
    by: dict[str, list[bytes]] = {}
    for text, language in rows:
        by.setdefault(language, []).append(text.lower().encode())
    names = sorted(by)
    return Model(names, [ContextTree.of(by[n], order) for n in names], order, uuid.uuid4().hex)


def training_rows(docs: DataFrame, usable: Column, doc_id: str, text: str, lang: str,
                  rows: int = ROWS_PER_LANGUAGE, longest: int = LONGEST_ROW) -> list[tuple[str, str]]:
    """About ``rows`` rows of each language, the same in every run; collected, as their number and length are bounded."""
    fit_on = docs.where(usable & F.col(text).isNotNull() & F.col(lang).isNotNull() & (F.length(text) <= longest)) \
        .select(F.col(doc_id).alias("i"), F.col(text).alias("t"), F.col(lang).alias("l"))
    n = {r["l"]: r["count"] for r in fit_on.groupBy("l").count().collect()}
    if not n:
        return []
    share = F.create_map(*[F.lit(x) for l, c in n.items() for x in (l, int((1 << 30) * min(1.0, rows / c)))])
    chosen = fit_on.where(F.pmod(F.xxhash64("i", "t"), F.lit(1 << 30)) < share[F.col("l")])
    return [(r["t"], r["l"]) for r in chosen.select("t", "l").limit(2 * rows * len(n)).collect()]


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, lang_pred, score, bits_per_byte.

    The score is the posterior of the predicted language under equal priors.  Texts
    that are null or have no letter, and all texts if no language was learned:
    ``und`` with score 0.  Equal code lengths: the first language by name.
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, raw in blocks(b.column(1), 1_000_000):
                texts = [(t or b"").decode(errors="replace").lower() for t in raw]
                lettered = [bool(model.languages) and LETTER.search(t) is not None for t in texts]
                coded = [t.encode() if ok else b"" for t, ok in zip(texts, lettered)]
                label, score, rate = [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
                if any(lettered):
                    bits = model.code_lengths(coded)
                    best = bits.argmin(axis=1)
                    odds = np.exp2(bits.min(axis=1, keepdims=True) - bits).sum(axis=1)
                    for i in np.flatnonzero(lettered).tolist():
                        label[i], score[i] = model.languages[best[i]], 1 / odds[i]
                        rate[i] = bits[i, best[i]] / len(coded[i])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, len(raw)), pa.array(label, pa.string()), pa.array(score), pa.array(rate)],
                    ["doc_id", "lang_pred", "score", "bits_per_byte"])

    return source.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, bits_per_byte double")
