"""Token ids of whole texts through a bounded cache of white-space separated chunks.

The word tokenizer drops white space and never joins symbols across it, so the
ids of a text are those of its chunks, one after the other.  Each worker
process keeps one cache, which tasks that follow use again; when it is full it
is emptied, so its size does not grow with the corpus.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Entries of a worker's cache (about 200 bytes each), and the longest chunk (bytes) that it keeps.
CACHE, LONGEST = 400_000, 64
#: Of a job that has the executors to itself.
LARGE_CACHE = 1_200_000


def worker_store(kind: str, key: object) -> dict:
    """A dict that lives as long as the worker process.

    It goes when another ``key`` of its kind is asked for, or a kind with another
    first word: a worker holds the caches of one operator at a time.
    """
    home = sys.modules.setdefault("tillroll_worker_store", types.ModuleType("tillroll_worker_store"))
    stores = home.__dict__.setdefault("stores", {})
    family = kind.split()[0]
    for other in [k for k in stores if k.split()[0] != family]:
        del stores[other]
    if kind not in stores or stores[kind][0] != key:
        stores[kind] = (key, {})
    return stores[kind][1]


def default_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def whole(chunk: bytes) -> tuple[bytes, bytes]:
    return chunk, b""


class ChunkEncoder:
    """Little-endian uint32 ids of texts; ``encode_chunks`` maps distinct chunks (bytes) to packed ids (bytes).

    ``parts`` names a chunk's stem and ending, whose ids together are the chunk's, so
    that chunks with one stem are encoded once.  A full cache is kept as long as it
    knows most chunks, and emptied otherwise.
    """

    def __init__(self, kind: str, key: object, encode_chunks: Callable[[list[bytes]], list[bytes]],
                 parts: Callable[[bytes], tuple[bytes, bytes]] = whole, cache: int = CACHE):
        self.known = worker_store(kind, key)
        self.encode_chunks = encode_chunks
        self.parts = parts
        self.cache = cache

    def encode(self, chunked: list[list[bytes]]) -> list[bytes]:
        known = self.known
        found = [list(map(known.get, chunks)) for chunks in chunked]
        gaps = [i for i, ids in enumerate(found) if None in ids]
        if gaps:
            new = {c for i in gaps for c, ids in zip(chunked[i], found[i]) if ids is None}
            if len(known) > self.cache and 2 * len(new) > sum(map(len, chunked)):
                known.clear()
            extra = self._encoded(new)
            if len(known) <= self.cache:
                known.update((c, ids) for c, ids in extra.items() if len(c) <= LONGEST)
            for i in gaps:
                found[i] = [extra[c] if ids is None else ids for c, ids in zip(chunked[i], found[i])]
        return [b"".join(ids) for ids in found]

    def _encoded(self, chunks: set[bytes]) -> dict[bytes, bytes]:
        parts = {c: self.parts(c) for c in chunks}
        have = {p: self.known[p] for pair in parts.values() for p in pair if p in self.known}
        have[b""] = b""
        stems = list({p for pair in parts.values() for p in pair if p not in have})
        for at in range(0, len(stems), 20_000):
            part = stems[at:at + 20_000]
            have.update(zip(part, self.encode_chunks(part)))
        return {c: have[stem] + have[end] for c, (stem, end) in parts.items()} | {s: have[s] for s in stems}


def stem_and_mark(chunk: bytes) -> tuple[bytes, bytes]:
    """The chunk without case and without a mark behind its last letter, and the mark.

    The word tokenizer lower-cases and cuts between letters and marks.  Chunks that
    may name a special token stay as they are.
    """
    if b"<|" in chunk:
        return chunk, b""
    low = chunk.lower()
    if low[-1:] in (b".", b",", b";", b":", b"!", b"?") and low[-2:-1].isalpha():
        return low[:-1], low[-1:]
    return low, b""


def word_encoder(path: str, cache: int = CACHE) -> Callable[[list[bytes | None]], list[bytes]]:
    """Texts (UTF-8, null: empty) to packed ids of the word tokenizer at ``path``, without special tokens."""
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    store = worker_store("word tokenizer", path)
    if "tk" not in store:
        store["tk"] = Tokenizer.from_file(path)
    tk = store["tk"]

    if "ends" not in store:  # ids of tokens that end a word
        vocabulary = tk.get_vocab()
        store["ends"] = np.zeros(max(vocabulary.values()) + 1, bool)
        store["ends"][[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
    ends = store["ends"]

    def one_by_one(texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in tk.encode_batch_fast(texts, add_special_tokens=False)]

    def as_words(words: list[str]) -> list[bytes]:
        """Ids of words of letters only, encoded as one text: each is one run of tokens up to a word's end."""
        ids = np.array(tk.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        last = ends[ids].nonzero()[0] + 1
        if len(last) != len(words):
            return one_by_one(words)
        packed = ids.tobytes()
        return [packed[4 * a:4 * b] for a, b in zip([0, *last[:-1].tolist()], last.tolist())]

    def encode_chunks(chunks: list[bytes]) -> list[bytes]:
        texts = [c.decode(errors="replace") for c in chunks]
        plain = [t.isalpha() and t.lower().isalpha() for t in texts]
        words = [t for t, ok in zip(texts, plain) if ok]
        found = iter([ids for at in range(0, len(words), 500) for ids in as_words(words[at:at + 500])])
        others = iter(one_by_one([t for t, ok in zip(texts, plain) if not ok]))
        return [next(found if ok else others) for ok in plain]

    encoder = ChunkEncoder("word ids", path, encode_chunks, stem_and_mark, cache)
    return lambda texts: encoder.encode([(t or b"").split() for t in texts])
