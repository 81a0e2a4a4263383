"""Toxic spans and document scores by a linear-chain conditional random field.

Only documents are labelled.  Tokens get their labels from counts over a bounded
sample of the labelled documents: in a toxic document the tokens are toxic whose word or prefix stands in many toxic
and next to no other documents, compared with the best of that document.  The
field has hashed word and prefix weights, a start weight and transitions, and
is fitted by stochastic gradients of the conditional likelihood; the marginals
of forward-backward give a document's score and its offending spans.
"""

from __future__ import annotations

import re
import sys
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, fraction_of
from .packing import blocks
from .wordcache import CACHE, worker_store

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Hashed features.
BUCKETS = 1 << 20
PREFIXES = (3, 4, 5, 6)
EDGE = ".,;:!?…\"'`´’‘“”«»()[]{}<>*#$%&|/\\-–—_~^=+@"
#: A cue stands in at least so many toxic documents and is so many times likelier there; of a document's cues those count
#: that stand in at least this share of the documents of its most frequent one.
CUE_DOCS, CUE_RATIO, CUE_SHARE = 3, 20.0, 0.3
#: Bounds of the labelled sample: documents of each label that the cues are counted on, and that the field is fitted on;
#: characters of a document of the fit (longer ones are not used).
LABELLED_DOCS, FIT_DOCS, FIT_CHARS = 8000, 1500, 20_000
TOKEN = re.compile(r"\S+")


def features(word: str) -> list[int]:
    """Hashed features of a token: its word and the word's prefixes."""
    core = word.lower().strip(EDGE)
    if not core:
        return []
    crc = zlib.crc32
    return [crc(b"w" + core.encode()) % BUCKETS] + [crc(b"p" + core[:k].encode()) % BUCKETS for k in PREFIXES if len(core) >= k]


def sketch(text: str) -> int:
    """The smallest hash of the text's 5-word shingles: near copies mostly share it."""
    words = text.encode().split()
    if len(words) < 5:
        return xxhash.xxh64_intdigest(b" ".join(words)) >> 1
    return min(map(xxhash.xxh64_intdigest, map(b" ".join, zip(*(words[i:] for i in range(5)))))) >> 1


@dataclass
class Field:
    """u_t: score of label 1 over 0 of token t; move[a, b]: of b after a (move[0, 0] = 0); start: of label 1 at the start."""
    weights: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS, np.float32))
    bias: float = -4.0
    start: float = 0.0
    move: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    calibration: np.ndarray = field(default_factory=lambda: np.array([-1.0, 1.0, 0.0]))
    token: str = ""

    def chain(self, u: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward and backward log odds of all tokens of many documents; ``first`` marks where one begins.

        r[t] = u[t] + f(r[t-1]) and b[t] = g(u[t+1] + b[t+1]) are iterated only where
        the value they hang on still changes.
        """
        m = self.move
        f = lambda x: np.logaddexp(m[0, 1], m[1, 1] + x) - np.logaddexp(m[0, 0], m[1, 0] + x)
        g = lambda x: np.logaddexp(m[1, 0], m[1, 1] + x) - np.logaddexp(m[0, 0], m[0, 1] + x)
        n = len(u)
        r = u + np.where(first, self.start, f(np.array(-np.inf)))
        at = (~first).nonzero()[0]
        while len(at):
            new = u[at] + f(r[at - 1])
            moved = np.abs(new - r[at]) > 1e-9
            r[at] = new
            at = at[moved] + 1
            at = at[at < n]
            at = at[~first[at]]
        last = np.append(first[1:], True)
        b = np.where(last, 0.0, g(np.array(-np.inf)))
        at = (~last).nonzero()[0]
        while len(at):
            new = g(u[at + 1] + b[at + 1])
            moved = np.abs(new - b[at]) > 1e-9
            b[at] = new
            at = at[moved] - 1
            at = at[at >= 0]
            at = at[~last[at]]
        return r, b

    def document_odds(self, z: np.ndarray) -> np.ndarray:
        return z @ self.calibration


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def evidence(logit: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per document: 1, the largest marginal's log odds, and the log of 1 + the expected number of toxic tokens."""
    z = np.zeros((len(sizes), 3))
    z[:, 0], z[:, 1] = 1, -15
    some = sizes > 0
    if some.any():
        at = starts[some]
        z[some, 1] = np.clip(np.maximum.reduceat(logit, at), -15, 15)
        z[some, 2] = np.log1p(np.add.reduceat(_sigmoid(logit), at))
    return z


def cue_counts(rows: DataFrame) -> DataFrame:
    """(bucket, n_clean, n_toxic): documents of each label with the feature; bucket -1: all.  rows: (text, toxic)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, BUCKETS + 1), np.int64)
        known: dict[str, list[int]] = {}
        for b in batches:
            for text, toxic in zip(b.column(0), b.column(1).to_pylist()):
                if len(known) > CACHE // 4:
                    known.clear()
                ids = {BUCKETS}
                for w in set((text.as_py() or "").split()):
                    found = known.get(w)
                    if found is None:
                        found = known[w] = features(w)
                    ids.update(found)
                n[toxic, list(ids)] += 1
        at = n.any(axis=0).nonzero()[0]
        for k in range(0, len(at), 50_000):
            part = at[k:k + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(np.where(part == BUCKETS, -1, part)), pa.array(n[0, part]),
                                              pa.array(n[1, part])], ["bucket", "n_clean", "n_toxic"])

    return rows.select("text", "toxic").mapInArrow(run, "bucket long, n_clean long, n_toxic long") \
        .groupBy("bucket").agg(F.sum("n_clean").alias("n_clean"), F.sum("n_toxic").alias("n_toxic"))


def different(rows: DataFrame) -> DataFrame:
    """(text, toxic[, share]) without most near copies: of each sketch and label the first text."""
    extra = [c for c in rows.columns if c == "share"]
    rows = rows.select("text", "toxic", *extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = [sketch(t.as_py() or "") for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(keys, pa.int64())], ["text", "toxic", *extra, "sketch"])

    schema = "text string, toxic int, " + "share double, " * len(extra) + "sketch long"
    return rows.mapInArrow(run, schema).groupBy("sketch", "toxic") \
        .agg(F.min("text").alias("text"), *[F.max(c).alias(c) for c in extra]).select("text", "toxic", *extra)


def fit(labelled: DataFrame, docs_of_label: int = FIT_DOCS, seed: int = 5) -> Field:
    """Fit on (text, toxic) rows.  Without rows of both labels: a field that scores every text low.

    A column ``share`` holds the share of toxic labels in the corpus that the rows were
    chosen from; without it, it is that of the rows.
    """
    model = Field(token=uuid.uuid4().hex)
    rows = cut(different(labelled), "labelled", True)
    counts = cut(cue_counts(rows), "cues", True)
    all_docs = {r["bucket"]: r for r in counts.where("bucket = -1").collect()}.get(-1)
    if all_docs is None or not all_docs["n_toxic"] or not all_docs["n_clean"]:
        return model
    n0, n1 = all_docs["n_clean"], all_docs["n_toxic"]
    share = rows.agg(F.max("share")).first()[0] if "share" in rows.columns else n1 / (n0 + n1)
    ratio = ((F.col("n_toxic") + 0.5) / (n1 + 1)) / ((F.col("n_clean") + 0.5) / (n0 + 1))
    cues = counts.where((F.col("bucket") >= 0) & (F.col("n_toxic") >= CUE_DOCS) & (ratio >= CUE_RATIO))
    support = np.zeros(BUCKETS, np.int64)
    for r in cues.select("bucket", "n_toxic").collect():  # at most BUCKETS rows
        support[r["bucket"]] = r["n_toxic"]
    chosen = F.when(F.col("toxic") == 1, fraction_of(F.xxhash64("text"), docs_of_label, n1)) \
        .otherwise(fraction_of(F.xxhash64("text"), docs_of_label, n0))
    sample = rows.where(chosen & (F.length("text") <= FIT_CHARS)).limit(4 * docs_of_label).collect()
    return _fit_sample(model, [(r["text"], r["toxic"]) for r in sample], support, share, seed)


def _fit_sample(model: Field, sample: list[tuple[str, int]], support: np.ndarray, share: float, seed: int,
                rounds: int = 6, per_step: int = 64, rate: float = 0.5) -> Field:
    sample = sorted(sample)
    rng = np.random.default_rng(seed)
    known: dict[str, int] = {}
    lists: list[list[int]] = []
    tokens, labels = [], []
    for text, toxic in sample:
        ids = []
        for w in text.split():
            i = known.get(w)
            if i is None:
                i = known[w] = len(lists)
                lists.append(features(w))
            ids.append(i)
        ids = np.array(ids, np.int64)
        tokens.append(ids)
        best = np.array([max((support[k] for k in lists[i]), default=0) for i in ids.tolist()], np.int64)
        most = best.max(initial=0)
        labels.append((best >= max(1, CUE_SHARE * most)) & (toxic == 1))
    width = 1 + len(PREFIXES)
    table = np.full((len(lists) + 1, width), BUCKETS, np.int64)  # padded with a weight that stays 0
    for i, x in enumerate(lists):
        table[i, :len(x)] = x
    w, square = np.zeros(BUCKETS + 1), np.full(BUCKETS + 1, 1e-2)
    rest_square = np.full(5, 1e-2)

    def chained(part: np.ndarray):
        sizes = np.array([len(tokens[d]) for d in part])
        flat = np.concatenate([tokens[d] for d in part]) if len(part) else np.zeros(0, np.int64)
        first = np.zeros(len(flat), bool)
        first[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
        u = w[table[flat]].sum(axis=1) + model.bias
        r, b = model.chain(u, first)
        return flat, first, sizes, u, r, b

    for _ in range(rounds):
        order = rng.permutation(len(sample))
        for at in range(0, len(order), per_step):
            part = order[at:at + per_step]
            flat, first, sizes, u, r, b = chained(part)
            if not len(flat):
                continue
            y = np.concatenate([labels[d] for d in part]).astype(float)
            off = _sigmoid(r + b) - y
            grad = np.bincount(table[flat].ravel(), np.repeat(off, width), BUCKETS + 1) + 1e-3 * w
            grad[BUCKETS] = 0
            nxt = (~first).nonzero()[0]  # positions with a predecessor
            one, two = r[nxt - 1], u[nxt] + b[nxt]
            m = model.move
            score = np.stack([np.zeros(len(nxt)), m[0, 1] + two, m[1, 0] + one, m[1, 1] + one + two])
            pair = np.exp(score - np.logaddexp.reduce(score, axis=0)).sum(axis=1)
            seen = np.bincount((2 * y[nxt - 1] + y[nxt]).astype(int), minlength=4)
            rest = np.concatenate([[off.sum(), off[first].sum()], (pair - seen)[1:]])
            touched = np.unique(table[flat])
            square[touched] += grad[touched] ** 2
            w[touched] -= rate * grad[touched] / np.sqrt(square[touched])
            rest_square += rest ** 2
            step = 0.2 * rest / np.sqrt(rest_square)
            model.bias -= step[0]
            model.start -= step[1]
            model.move = m - np.array([[0, step[2]], [step[3], step[4]]])
    w[BUCKETS] = 0
    model.weights = w[:BUCKETS].astype(np.float32)
    z = []
    for at in range(0, len(sample), per_step):
        _, _, sizes, _, r, b = chained(np.arange(at, min(at + per_step, len(sample))))
        z.append(evidence(r + b, np.cumsum(sizes) - sizes, sizes))
    toxic = np.array([t for _, t in sample], float)
    model.calibration = _calibrate(np.concatenate(z), toxic, share)
    return model


def _calibrate(z: np.ndarray, y: np.ndarray, share: float) -> np.ndarray:
    """Logistic regression by Newton steps, the labels weighed as in the corpus."""
    part = min(max(y.mean(), 1e-6), 1 - 1e-6)
    weight = np.where(y == 1, share / part, (1 - share) / (1 - part))
    c = np.zeros(z.shape[1])
    for _ in range(30):
        p = _sigmoid(z @ c)
        grad = z.T @ (weight * (p - y)) + 1e-2 * c
        hess = (z * (weight * p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(len(c))
        c = c - np.linalg.solve(hess, grad)
    return c


class Scorer:
    """A fitted field as tasks use it: only the weights that are not zero travel."""

    def __init__(self, model: Field):
        self.at = model.weights.nonzero()[0].astype(np.int32)
        self.values = model.weights[self.at]
        self.field = Field(np.zeros(0, np.float32), model.bias, model.start, model.move, model.calibration, model.token)

    def scores(self, words: list[str]) -> np.ndarray:
        """Score of label 1 over 0 of each token by itself, through the worker's cache."""
        store = worker_store("crf", self.field.token)
        if not store:
            store["w"] = np.zeros(BUCKETS, np.float32)
            store["w"][self.at] = self.values
            store["known"] = {}
        w, known, bias = store["w"], store["known"], self.field.bias
        u = list(map(known.get, words))
        if None in u:
            gaps = {x for x, score in zip(words, u) if score is None}
            if len(known) > CACHE // 2 and 2 * len(gaps) > len(words):
                known.clear()
            cores = {x: x.lower().strip(EDGE) for x in gaps}
            of_core = {c: bias + sum(w.item(i) for i in features(c)) for c in set(cores.values())}
            new = {x: of_core[c] for x, c in cores.items()}
            if len(known) <= CACHE // 2:
                known.update(new)
            u = [new[x] if score is None else score for x, score in zip(words, u)]
        return np.array(u, np.float64)

    def documents(self, texts: list[str | None]) -> tuple[np.ndarray, list[list[int]]]:
        """Score of each text, and the numbers of its toxic tokens."""
        words = [(t or "").split() for t in texts]
        sizes = np.array([len(ws) for ws in words], np.int64)
        u = self.scores(list(chain.from_iterable(words)))
        starts = np.cumsum(sizes) - sizes
        first = np.zeros(len(u), bool)
        first[starts[sizes > 0]] = True
        r, back = self.field.chain(u, first)
        logit = r + back
        p = _sigmoid(self.field.document_odds(evidence(logit, starts, sizes)))
        hits: list[list[int]] = [[] for _ in texts]
        for t in (logit >= 0).nonzero()[0].tolist():
            d = int(np.searchsorted(starts, t, "right")) - 1
            hits[d].append(t - int(starts[d]))
        return p, hits


def spans(text: str, tokens: list[int]) -> str:
    """The tokens as start:end in code points, end exclusive, comma-joined."""
    wanted = set(tokens)
    return ",".join(f"{m.start()}:{m.end()}" for k, m in enumerate(TOKEN.finditer(text)) if k in wanted) if tokens else ""


def score(docs: DataFrame, model: Field, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, score, predicted, n_toxic_tokens, spans.

    Null and empty texts have no tokens and the score of no evidence.  Rows are
    independent; other columns are not read.
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    scorer = Scorer(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, texts in blocks(b.column(1), 2_000_000):
                p, hits = scorer.documents(texts)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, len(texts)), pa.array(p), pa.array((p >= 0.5).astype(np.int32)),
                     pa.array([len(h) for h in hits], pa.int64()),
                     pa.array([spans(t or "", h) for t, h in zip(texts, hits)], pa.string())],
                    ["doc_id", "score", "predicted", "n_toxic_tokens", "spans"])

    return source.mapInArrow(run, f"doc_id {kind}, score double, predicted int, n_toxic_tokens long, spans string")


def keep_clean(docs: DataFrame, model: Field, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is below one half, all columns as they were."""
    scorer, place = Scorer(model), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, texts in blocks(b.column(place), 2_000_000):
                yield b.slice(first, len(texts)).filter(pa.array(scorer.documents(texts)[0] < 0.5))

    return docs.mapInArrow(run, docs.schema)


def labelled_rows(docs: DataFrame, labels: DataFrame, held_out: Callable[[Column], Column],
                  rows_of_label: int = LABELLED_DOCS) -> DataFrame:
    """(text, toxic, share) of the documents to learn from: about ``rows_of_label`` of each label, chosen by a hash of the id.

    ``held_out(doc_id)`` rows are left out; of several labels of an id the larger
    counts.  The chosen labels are bounded, so they are broadcast and no text moves.  ``share`` is the share of toxic ones among all usable
    labels, which the sample, bounded for each label, does not have.
    """
    known = labels.where(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id") \
        .agg(F.max("toxic").cast("int").alias("toxic"))
    n = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    some = known.where(F.when(F.col("toxic") == 1, fraction_of(F.xxhash64("doc_id"), rows_of_label, n.get(1, 0)))
                       .otherwise(fraction_of(F.xxhash64("doc_id"), rows_of_label, n.get(0, 0))))
    some = some.limit(4 * rows_of_label)
    share = F.lit(n.get(1, 0) / max(1, n.get(0, 0) + n.get(1, 0)))
    return docs.where(F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(some), "doc_id") \
        .select("text", "toxic", share.alias("share"))
