"""Repeated byte strings, importance resampling and whitening against brute-force versions, and odd rows."""
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import bitslice, bwtmerge, queries, whitening
from tillroll.llm.common import table

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, n_words string, kept string, t string, place int, weight string, key string"
LINE = "The quick brown fox jumps over the lazy dog, and then the dog gets up and runs after it. "
ODD = [None, "", "  \n ", "word", "a" * 700, "a" * 199, "ab" * 400, LINE * 5, "x" + LINE * 3, "é漢字😀" * 90, "same text here " * 20,
       "same text here " * 20, "Word word WORD, 12-ab_cd é😀é x y " * 9, " ".join(f"w{i % 7}" for i in range(5000))]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(None if i == 3 else i % 9, t, "n", "k", "t", i, "w", "y") for i, t in enumerate(ODD)], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SMALL, "documents")


def rows_of(df):
    return [tuple(r) for r in df.collect()]


# 11 suffix-array dedup
def brute_repeats(df, length):
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in df.select("doc_id", "text").collect()]
    seen = Counter(t[i:i + length] for _, t in rows for i in range(len(t) - length + 1))
    out = []
    for doc_id, t in rows:
        covered = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                covered[i:i + length] = True
        edges = np.diff(np.r_[0, covered.astype(int)])
        kept = bytes(b for b, c in zip(t, covered) if not c)
        out.append((doc_id, len(t), int(covered.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def found_repeats(df, **kw):
    got = bwtmerge.remove_repeats(df, **kw)
    return Counter(rows_of(got.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))))


@pytest.mark.parametrize("which,group_bytes", [("odd", 1 << 22), ("odd", 500), ("docs", 1 << 22), ("docs", 2000), ("none", 500)])
def test_repeats_against_brute_force(request, which, group_bytes):
    df = request.getfixturevalue(which)
    assert found_repeats(df, group_bytes=group_bytes) == brute_repeats(df, 200)


def test_repeats_in_a_crowded_anchor(spark):
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdef"), 30))
    passage = "".join(rng.choice(list("ghijkl"), 90))
    heads = [word() for _ in range(3)]
    rows = [(i, word() + heads[i % 3] + passage + (word() if i % 4 else heads[0])) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_repeats(df, 100)
    assert sum(k[2] for k in want) > 0
    assert found_repeats(df, length=100, group_bytes=1000) == want == found_repeats(df, length=100)


def test_repeats_by_piece(spark, monkeypatch):
    rng = np.random.default_rng(2)
    text = "".join(rng.choice(list("abcd"), 4000))
    df = spark.createDataFrame([(1, text + text[500:1500]), (2, text[2000:2600])], "doc_id long, text string")
    monkeypatch.setattr(bwtmerge.scan_contexts, "__defaults__", (700,))
    assert found_repeats(df) == brute_repeats(df, 200)


def test_merged_transform_is_the_sorted_order():
    rng = np.random.default_rng(1)
    shards = [bytes(rng.integers(97, 99, n).astype(np.uint8)) for n in (1, 300, 2000, 900)]
    shards[1] += shards[2][:500] * 2
    order, rank = bwtmerge.merge(shards, 40)
    x = b"".join(shards)
    whole = [i for i in order if i + 40 <= len(x)]
    assert [x[i:i + 40] for i in whole] == sorted(x[i:i + 40] for i in range(len(x) - 39))
    classes = {}
    for i in whole:
        classes.setdefault(rank[i], set()).add(x[i:i + 40])
    assert all(len(v) == 1 for v in classes.values()) and len(classes) == len({x[i:i + 40] for i in whole})


# 12 importance resampling
def brute_features(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return len(words), Counter(zlib.crc32(" ".join(words[i:i + n]).encode()) % 10000
                               for n in (1, 2, 3) for i in range(len(words) - n + 1))


def brute_resample(docs, target):
    rows = [(r["doc_id"], *brute_features(r["text"])) for r in docs.select("doc_id", "text").collect()]
    s, t = Counter(), Counter()
    for _, _, f in rows:
        s.update(f)
    for r in target.select("text").collect():
        t.update(brute_features(r["text"])[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000)))) for b in range(10000)]
    out = []
    for doc_id, n_words, f in rows:
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] * n for b, n in f.items())
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, n_words, sum(f.values()), weight, score, None])
    drawable = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for i, r in enumerate(drawable[:5 * len(drawable) // 100]):
        r[5] = i + 1
    return Counter(map(tuple, out))


@pytest.mark.parametrize("which", ["odd", "docs", "none"])
def test_resampling_against_brute_force(spark, request, which):
    df = request.getfixturevalue(which)
    target = table(spark, SMALL, "benchmark")
    got = bitslice.resample(df, target)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert Counter(rows_of(got)) == brute_resample(df, target)


def test_resampling_ranks_ties_by_id(spark):
    rows = [(i // 2, " ".join(["tie"] * 30)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([], "text string")
    got = sorted((r["rank"], -r["score"], r["doc_id"]) for r in bitslice.resample(df, target).where("rank is not null").collect())
    assert [r[0] for r in got] == list(range(1, 21)) and [r[1:] for r in got] == sorted(r[1:] for r in got)


def test_joined_crc_and_planes():
    crc = bitslice.Crc()
    parts = [(b"a", b"b"), (b"left", b"x" * 200), (b"", b"\xff\x00" * 33), (b"q" * 90, b"")]
    a = np.array([zlib.crc32(x) for x, _ in parts], np.uint32)
    b = np.array([zlib.crc32(y) for _, y in parts], np.uint32)
    size = np.array([len(y) for _, y in parts], np.int32)
    assert (crc.shift(crc.space(a), size) ^ b).tolist() == [zlib.crc32(x + b" " + y) for x, y in parts]
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 70, (5, 10000)) * (rng.random((5, 10000)) < 0.1)
    gains = rng.integers(-9000, 9000, 10000)
    assert bitslice.weigh(counts, bitslice.gain_planes(gains)) == (counts @ gains).tolist()


def test_words_of_cut_pieces():
    text = ("Some words, é漢字 and a " + "long" * 50 + " one. ").encode() * 9
    want = bitslice._words(text)
    for piece in (7, 31, 64, 1000):
        got = bitslice._words(text, piece)
        assert got[0].tolist() == want[0].tolist() and got[1].tolist() == want[1].tolist()


# 13 embedding whitening
@pytest.mark.parametrize("d,kind", [(2, "even"), (5, "even"), (40, "even"), (40, "equal"), (33, "blocks"), (12, "rank one"), (1, "even")])
def test_leading_components_against_lapack(d, kind):
    rng = np.random.default_rng(d)
    q, _ = np.linalg.qr(rng.standard_normal((d, d)))
    if kind == "even":
        a = q @ np.diag(rng.random(d) * 100) @ q.T
    elif kind == "equal":
        a = q @ np.diag(np.r_[np.full(9, 7.0), 3 + 1e-13 * np.arange(d - 9)]) @ q.T
    elif kind == "blocks":
        a = np.diag(np.repeat([5.0, 2.0, 1.0], d // 3))
    else:
        a = np.outer(q[0], q[0])
    a = (a + a.T) / 2
    k = min(d, 32)
    values, vectors = whitening.leading_components(a, k)
    want = np.linalg.eigvalsh(a)[::-1][:k]
    assert np.abs(values - want).max() <= 1e-13 * max(1, abs(want[0])) * d
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-10
    assert np.abs(a @ vectors - vectors * values).max() < 1e-10 * max(1, abs(want[0]))


def test_whitening_against_brute_force(spark):
    v = table(spark, SMALL, "embeddings").withColumn("n", F.lit("clash")).withColumn("whitened", F.lit(1))
    rows = [(r["vec_id"], r["embedding"]) for r in v.collect()]
    x = np.floor(64 * np.array([e for _, e in rows], float)).astype(int) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    y = x - s / n
    cov = (y - y.mean(axis=0)).T @ (y - y.mean(axis=0)) / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:32], axes[:, ::-1][:, :32]
    want = y @ axes / np.sqrt(values)
    got = {(r["vec_id"], r["component"]): r for r in whitening.whiten(v).collect()}
    assert len(got) == 32 * n
    for j in range(32):
        mine = np.array([got[i, j + 1]["whitened"] for i, _ in rows])
        assert np.abs(mine * np.sign(mine @ want[:, j]) - want[:, j]).max() < 1e-8
        assert abs(got[rows[0][0], j + 1]["explained"] - values[j] / np.trace(cov)) < 1e-12
    assert [got[i, 1]["deviation"] for i, _ in rows] == [sum(int(n * a - b) ** 2 for a, b in zip(r.tolist(), s.tolist())) for r in x]
    assert all(r["n"] == n and r["identity_error"] < 1e-10 for r in got.values())


def test_whitening_odd_rows(spark):
    rng = np.random.default_rng(3)
    good = [(i, rng.standard_normal(4).tolist()) for i in range(30)] + [(None, [1.0, 2.0, 3.0, 4.0]), (5, [0.0] * 4)]
    bad = [(50, None), (51, []), (52, [1.0, None, 2.0, 3.0]), (53, [float("nan")] * 4), (54, [float("inf"), 1.0, 2.0, 3.0])]
    short = [(60 + i, rng.standard_normal(2).tolist()) for i in range(9)]
    kind = "vec_id long, embedding array<float>"
    got = whitening.whiten(spark.createDataFrame(good + bad + short, kind)).collect()
    assert Counter((r["vec_id"], r["n"]) for r in got) == Counter(
        [(i, 32) for i, _ in good for _ in range(4)] + [(i, 9) for i, _ in short for _ in range(2)])
    assert max(r["identity_error"] for r in got) < 1e-10
    assert whitening.whiten(spark.createDataFrame([], kind)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 5, kind)).count() == 0


@pytest.mark.parametrize("name,columns", [
    ("op11_suffix_dedup", "doc_id n_bytes n_removed n_spans kept_sha256"),
    ("op12_target_resampling", "doc_id n_features weight score rank n_words"),
    ("op13_embedding_whitening", "vec_id component n deviation whitened explained identity_error")])
def test_queries_run(spark, name, columns):
    assert queries.QUERIES[name](spark, SMALL).columns == columns.split()
