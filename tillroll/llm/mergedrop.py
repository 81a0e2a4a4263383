"""SentencePiece encoding with seeded merge-dropout, and decoding.

The agenda holds the candidate merges of neighbouring symbols; the one with the
best score, leftmost among equals, is taken next, and is skipped for good with
the dropout's probability.  How many candidates are taken between two skipped
ones is drawn by a keyed hash of (seed, text, position of the word, number of
the draw): every occurrence of a word draws afresh, and a segmentation is the
same in every run and on every executor.  What a word becomes once the skipped
candidates are known is cached.  Many words are worked on together: one agenda
step takes the best candidate of each word.

A text is cut before every run of the space mark and around characters that no
piece of several characters holds; no merge crosses these borders.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
import zlib
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packing import blocks
from .wordcache import CACHE, LONGEST, default_path, worker_store

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPACE = "▁"
NEVER = np.iinfo(np.int64).max
#: Symbols that no piece has: characters without a piece, from ``BARE`` on, and what stands behind a word.
BARE = 1 << 24
END = BARE - 1
#: Cells of places x words that are worked on at once.
CELLS = 1 << 18
#: Words that are cut at once.
PART = 100_000


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gaps(keys: np.ndarray, draw: int, dropout: float) -> np.ndarray:
    """Candidates taken before the next skipped one: geometric, from the hash of (key, draw)."""
    if dropout <= 0:
        return np.full(len(keys), NEVER >> 1)
    drawn = _mix(keys + np.uint64(draw * 0x9E3779B97F4A7C15 % 2 ** 64)) >> np.uint64(11)
    with np.errstate(divide="ignore"):
        return np.floor(np.log((drawn + 0.5) * 2.0 ** -53) / np.log1p(-min(dropout, 1.0))).clip(0, 2 ** 40).astype(np.int64)


class Merges:
    """The merge table of a SentencePiece BPE model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        usable = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.ids = {self.pieces[i]: i for i in usable}
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        byte_of = {i: bytes([b]) for b, i in enumerate(self.byte_ids)}
        self.spelled = [byte_of[i] if i in byte_of else b"" if sp.is_control(i) else self.pieces[i].replace(SPACE, " ").encode()
                        for i in range(n)]
        order = sorted(usable, key=lambda i: -sp.get_score(i))
        rank = {}
        for place, (i, before) in enumerate(zip(order, [None, *order])):  # equal scores are equal ranks
            same = before is not None and sp.get_score(i) == sp.get_score(before)
            rank[i] = rank[before] if same else place
        single = {ord(p): i for p, i in self.ids.items() if len(p) == 1}
        self.of_char = np.full(max(single) + 1, -1, np.int64)
        self.of_char[list(single)] = list(single.values())
        pairs = {}
        for piece, i in self.ids.items():
            for k in range(1, len(piece)):
                left, right = self.ids.get(piece[:k]), self.ids.get(piece[k:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = (rank[i], i)
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k][0] for k in self.keys.tolist()], np.int64)
        self.merged = np.array([pairs[k][1] for k in self.keys.tolist()], np.int64)
        self.slots = self._hashed()
        joined = {c for p in self.ids if len(p) > 1 for c in p}
        inside = "".join(re.escape(c) for c in sorted(joined - {SPACE}))
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece holds the space mark after another character")
        self.cut = re.compile(f"{SPACE}*[{inside}]+|{SPACE}+|[^{SPACE}{inside}]")

    def chunks(self, text: str) -> list[str]:
        """Chunks whose concatenation is the text with a space mark in front and for each space."""
        return self.cut.findall(SPACE + text.replace(" ", SPACE))

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The place of each pair in the table, -1 for none."""
        key = (left.astype(np.int64) << np.int64(32)) | right
        at = self._home(key)
        place = self.slots[at]
        wrong = ((place >= 0) & (self.keys[place] != key)).nonzero()[0]
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & (len(self.slots) - 1)
            place[wrong] = self.slots[at[wrong]]
            wrong = wrong[(place[wrong] >= 0) & (self.keys[place[wrong]] != key[wrong])]
        return place

    def _home(self, key: np.ndarray) -> np.ndarray:
        drawn = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (drawn >> np.uint64(65 - len(self.slots).bit_length())).astype(np.int64)

    def _hashed(self) -> np.ndarray:
        """Places of the pairs in a hash table with linear probing."""
        self.slots = np.full(1 << (8 * len(self.keys) + 1).bit_length(), -1, np.int32)
        left, at = np.arange(len(self.keys)), self._home(self.keys)
        while len(left):
            free = self.slots[at] < 0
            self.slots[at[free]] = left[free]
            again = self.slots[at] != left
            left, at = left[again], (at[again] + 1) & (len(self.slots) - 1)
        return self.slots

    def segment(self, chunks: list[str], skipped: Sequence[Sequence[int]]) -> list[tuple[int, bytes]]:
        """(candidates considered, packed ids) of each chunk.

        ``skipped`` are the chunk's numbers, ascending, of the candidates that are
        dropped, counted in the order in which the agenda comes to them.
        """
        considered, ids, start, size = self.segmented(chunks, skipped)
        packed = ids.tobytes()
        return [(n, packed[4 * a:4 * (a + k)]) for n, a, k in zip(considered.tolist(), start.tolist(), size.tolist())]

    def segmented(self, chunks: list[str], skipped: Sequence[Sequence[int]]) -> tuple[np.ndarray, ...]:
        """``segment`` as arrays: candidates considered, the ids of all chunks, and where each chunk's begin and how many they are."""
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        points = np.frombuffer("".join(chunks).encode("utf-32-le"), "<u4").astype(np.int64)
        sym = np.where(points < len(self.of_char), self.of_char[np.minimum(points, len(self.of_char) - 1)], -1)
        sym = np.append(np.where(sym < 0, BARE + points, sym), END).astype(np.int32)
        first = np.cumsum(sizes) - sizes
        plan = np.array([x for p in skipped for x in (*p, -1)], np.int64)
        lengths = np.fromiter(map(len, skipped), np.int64, len(skipped)) + 1
        planned = np.cumsum(lengths) - lengths
        considered, size = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
        order = np.argsort(sizes, kind="stable")
        ordered, words, found, at = sizes[order], [], [], 0
        while at < len(order):  # words of about one length
            most = int(ordered[at]) * 5 // 4 + 1
            upto = min(int(np.searchsorted(ordered, most, "right")), at + max(1, CELLS // most))
            own, at = order[at:upto], upto
            place = first[own] + np.arange(sizes[own[-1]] + 2)[:, None]
            inside = np.arange(len(place))[:, None] < sizes[own]
            for done, ids, n in self._grown(np.where(inside, sym[np.where(inside, place, -1)], END), own, plan, planned, considered):
                words.append(done)
                found.append(ids)
                size[done] = n
        words, ids = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (words, found))
        start = np.zeros(len(chunks), np.int64)
        start[words] = np.cumsum(size[words]) - size[words]
        bare = (ids >= BARE).nonzero()[0]
        if len(bare):  # characters without a piece are spelled in bytes
            spelled = [[self.byte_ids[b] for b in chr(x - BARE).encode()] for x in ids[bare].tolist()]
            wide = np.ones(len(ids), np.int64)
            wide[bare] = [len(x) for x in spelled]
            ends = np.append(0, np.cumsum(wide))
            ids = np.repeat(ids, wide)
            for x, a in zip(spelled, ends[bare].tolist()):
                ids[a:a + len(x)] = x
            start, size = ends[start], ends[start + size] - ends[start]
        return considered, ids.astype("<u4"), start, size

    def _grown(self, sym: np.ndarray, word: np.ndarray, plan: np.ndarray, planned: np.ndarray,
               considered: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Merges the words of the columns of ``sym`` to the end; (words, their ids, ids of each) as they are done.

        ``sym`` has a row for each place and END below each word.  Places keep their number: a merged symbol stands at
        its first one.  The last row is never a candidate; it is also what stands before the first place."""
        last, n = sym.shape[0] - 1, sym.shape[1]
        kind = np.int32 if len(self.keys) and (int(self.ranks.max()) + 1) * (last + 1) < 2 ** 31 - 1 else np.int64
        never = np.iinfo(kind).max
        ranks, merged = np.append(self.ranks, 0), np.append(self.merged, 0)
        place = np.full(sym.shape, -1, np.int32)
        place[:last] = self.look_up(sym[:last].ravel(), sym[1:].ravel()).reshape(last, n)
        rows = np.arange(last + 1)[:, None]
        rank = np.where(place < 0, never, ranks[place] * (last + 1) + rows).astype(kind)
        after = np.broadcast_to(np.minimum(rows + 1, last), sym.shape).astype(np.int32)
        before = np.broadcast_to(np.where(rows > 0, rows - 1, last), sym.shape).astype(np.int32)
        while True:
            best = rank[:last].min(axis=0)
            live = best != never
            left = np.count_nonzero(live)
            if left < 0.7 * n or not left:
                done = sym[:, ~live].T
                kept = done != END
                yield word[~live], done[kept], kept.sum(axis=1)
                if not left:
                    return
                sym, place, rank, after, before = (np.ascontiguousarray(x[:, live]) for x in (sym, place, rank, after, before))
                word, best, n = word[live], best[live], left
                col = np.arange(n)
            else:
                col = live.nonzero()[0]
                best = best[col]
            of = word[col]
            skip = plan[planned[of]] == considered[of]
            considered[of] += 1
            planned[of] += skip
            at = best.astype(np.int64) % (last + 1)
            # one place of a column each: flat views of the tables
            sym_, place_, rank_, after_, before_ = (x.reshape(-1) for x in (sym, place, rank, after, before))
            rank_[at[skip] * n + col[skip]] = never  # until one of its symbols grows, which makes it another candidate
            at, col = at[~skip], col[~skip]
            here = at * n + col
            gone = after_[here].astype(np.int64) * n + col
            then = after_[gone]
            follow = then.astype(np.int64) * n + col
            sym_[here], sym_[gone], rank_[gone] = merged[place_[here]], END, never
            after_[here], before_[follow] = then, at
            front = before_[here].astype(np.int64) * n + col
            again = np.concatenate([here, front])
            found = self.look_up(sym_[again], sym_[np.concatenate([follow, here])])
            place_[again] = found
            rank_[again] = np.where(found < 0, never, ranks[found] * (last + 1) + again // n)

    def decode(self, ids: list[int]) -> str:
        """The text of any segmentation: the inverse of encoding."""
        text = b"".join(map(self.spelled.__getitem__, ids)).decode(errors="replace")
        return text[1:] if text[:1] == " " else text


def merges(path: str) -> Merges:
    store = worker_store("merge table", path)
    if "m" not in store:
        store["m"] = Merges(path)
    return store["m"]


class Cuts:
    """How chunks are cut: a state for each chunk, and for each state and next skipped candidate another one.

    The first ``CACHE`` states are kept; once there are more, the others last for a block, until most
    chunks of a block are unknown and all are forgotten."""

    def __init__(self, table: Merges):
        self.table = table
        self.clear()

    def clear(self) -> None:
        self.number: dict = {}  # chunk, or state << 32 | candidate: state
        self.keys, self.chunks, self.skipped = [], [], []
        self.considered = self.start = self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, "<u4")
        self.kept, self.strange = None, False
        self.add([""], [SPACE], [()])
        # the mark itself, spelled in bytes
        self.ids, self.considered = np.array([self.table.byte_ids[b] for b in SPACE.encode()], "<u4"), np.zeros(1, np.int64)
        self.start, self.size = np.zeros(1, np.int64), np.array([len(self.ids)])

    def trim(self) -> None:
        """Before each block."""
        if self.strange and len(self.keys) > CACHE:
            self.clear()
        if self.kept is None:
            self.kept = len(self.keys) if len(self.keys) > CACHE else None
        elif len(self.keys) > self.kept:
            for k in self.keys[self.kept:]:
                if k is not None:
                    del self.number[k]
            for x in (self.keys, self.chunks, self.skipped):
                del x[self.kept:]
            self.considered, self.start, self.size = (x[:self.kept] for x in (self.considered, self.start, self.size))
            self.ids = self.ids[:int((self.start + self.size).max())]

    def add(self, keys: list, chunks: list[str], skipped: list[Sequence[int]]) -> np.ndarray:
        """The states of new ``keys``; a key None is not found again."""
        at, first = len(self.keys), len(self.keys)
        for i in range(0, len(chunks), PART):
            considered, ids, start, size = self.table.segmented(chunks[i:i + PART], skipped[i:i + PART])
            self.considered, self.size = np.append(self.considered, considered), np.append(self.size, size)
            self.start, self.ids = np.append(self.start, start + len(self.ids)), np.append(self.ids, ids)
        for k in keys:
            if k is not None:
                self.number[k] = at
            at += 1
        self.keys += keys
        self.chunks += chunks
        self.skipped += skipped
        return np.arange(first, at)

    def undropped(self, chunks: list[str]) -> np.ndarray:
        found = list(map(self.number.get, chunks))
        missed = [c for c, s in zip(chunks, found) if s is None]
        self.strange = 2 * len(missed) > len(chunks)
        if missed:
            new = list(dict.fromkeys(missed))
            self.add(new, new, [()] * len(new))
            found = list(map(self.number.__getitem__, chunks))
        return np.array(found, np.int64)

    def dropped(self, state: np.ndarray, candidate: np.ndarray) -> np.ndarray:
        """The states that follow on ``state`` when ``candidate`` is skipped next."""
        keys, back = np.unique(state << 32 | candidate, return_inverse=True)
        keys = keys.tolist()
        found = list(map(self.number.get, keys))
        new = [k for k, s in zip(keys, found) if s is None]
        if new:
            self.add(new, [self.chunks[k >> 32] for k in new], [(*self.skipped[k >> 32], k & 0xFFFFFFFF) for k in new])
            found = list(map(self.number.__getitem__, keys))
        return np.array(found, np.int64)[back]

    def packed(self, state: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The packed ids of the states, one after the other, and the border in bytes before each and behind the last."""
        size = self.size[state]
        border = np.append(0, np.cumsum(size))
        return self.ids[np.repeat(self.start[state] - border[:-1], size) + np.arange(border[-1])].tobytes(), 4 * border


def encoder(path: str, dropout: float, seed: int, variants: int | None = None):
    """Texts (bytes) to packed ids.  With ``variants``, texts share so many streams of draws; else each has its own."""
    table = merges(path)
    store = worker_store("merge ids", (path,))
    if "cuts" not in store:
        store["cuts"] = Cuts(table)
    cuts = store["cuts"]

    def encode_chunks(chunks: list[str], keys: np.ndarray) -> np.ndarray:
        """The state of each chunk."""
        long = [i for i, c in enumerate(chunks) if len(c) > LONGEST]  # are drawn to the end at once, and not cached
        if long:
            chunks = chunks.copy()
            plans, whole = [], [chunks[i] for i in long]
            for i in long:
                most, drops = 3 * len(chunks[i]), []  # a chunk of n symbols has under n merges, each makes two candidates
                while not drops or drops[-1] < most:
                    gap = gaps(keys[i:i + 1], len(drops), dropout).item()
                    drops.append((drops[-1] + 1 if drops else 0) + gap)
                plans.append(drops)
                chunks[i] = ""
        state = cuts.undropped(chunks)
        drop = gaps(keys, 0, dropout)
        at = (drop < cuts.considered[state]).nonzero()[0]
        drop, draw = drop[at], 1
        while len(at):
            state[at] = cuts.dropped(state[at], drop)
            drop = drop + 1 + gaps(keys[at], draw, dropout)
            more = (drop < cuts.considered[state[at]]).nonzero()[0]
            at, drop, draw = at[more], drop[more], draw + 1
        if long:
            state[long] = cuts.add([None] * len(long), whole, plans)
        return state

    def encode(texts: list[bytes | None]) -> list[bytes]:
        chunks: list[str] = []
        ends, streams = [], []
        for t in texts:
            if t:
                text = t.decode(errors="replace")
                parts = text.split(SPACE)
                chunks += table.chunks(parts[0])
                for p in parts[1:]:  # the mark itself is spelled in bytes, so that decoding gives it back
                    chunks.append("")
                    chunks += table.cut.findall(p.replace(" ", SPACE))
            ends.append(len(chunks))
            stream = xxhash.xxh64_intdigest(t or b"", seed)
            streams.append(xxhash.xxh64_intdigest((stream % variants).to_bytes(8, "little"), seed) if variants else stream)
        starts = np.array([0, *ends[:-1]], np.int64)
        sizes = np.array(ends, np.int64) - starts
        place = np.arange(len(chunks)) - np.repeat(starts, sizes)
        keys = _mix(np.repeat(np.array(streams, np.uint64), sizes) + _mix(place.astype(np.uint64) + np.uint64(1)))
        cuts.trim()
        packed, border = cuts.packed(encode_chunks(chunks, keys))
        border = border[np.append(0, ends)].tolist()
        return [packed[a:b] for a, b in zip(border, border[1:])]

    return encode


def encode(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", dropout: float = 0.1, seed: int = 13,
           variants: int | None = None, model: str | None = None, with_ids: bool = True, verify: bool = False) -> DataFrame:
    """One row per document: doc_id, n_ids, ids_crc32[, ids (array<int>)][, lossless: the ids decode to the text].

    Null and empty texts have no ids.  Every occurrence of a word draws its dropped
    merges afresh, by a keyed hash of the text and the position; equal texts are
    encoded alike.  With ``variants``, the texts share so many streams of draws.
    With dropout 0 the ids are those of the SentencePiece library.  Other columns
    are not read.
    """
    path = model or default_path("piece_bpe_32k.model")
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    schema = f"doc_id {kind}, n_ids long, ids_crc32 long" + ", ids array<int>" * with_ids + ", lossless boolean" * verify
    names = ["doc_id", "n_ids", "ids_crc32"] + ["ids"] * with_ids + ["lossless"] * verify

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, dropout, seed, variants)
        for b in batches:
            for first, texts in blocks(b.column(1), 2_000_000):
                packed = enc(texts)
                columns = [b.column(0).slice(first, len(texts)), pa.array([len(p) // 4 for p in packed], pa.int64()),
                           pa.array([zlib.crc32(p) for p in packed], pa.int64())]
                if with_ids:
                    ids = [np.frombuffer(p, "<u4").astype(np.int32) for p in packed]
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                if verify:
                    table = merges(path)
                    columns.append(pa.array([table.decode(np.frombuffer(p, "<u4").tolist()) == (t or b"").decode(errors="replace")
                                             for p, t in zip(packed, texts)]))
                yield pa.RecordBatch.from_arrays(columns, names)

    return source.mapInArrow(run, schema)


def decode(encoded: DataFrame, ids: str = "ids", model: str | None = None) -> DataFrame:
    """``encoded`` with the column ``decoded``: the text of the ids (null ids: null)."""
    path = model or default_path("piece_bpe_32k.model")
    names = [c for c in encoded.columns if c != "decoded"]
    source = encoded.select(*[F.col(f"`{c}`") for c in names], F.col(ids).alias("__ids"))
    schema = encoded.select(*names).withColumn("decoded", F.lit("")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = merges(path)
        for b in batches:
            texts = [None if x is None else table.decode(x) for x in b.column(len(names)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string())], [*names, "decoded"])

    return source.mapInArrow(run, schema)
