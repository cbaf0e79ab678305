"""Lexical retrieval packing.

Documents are dealt by hash into shards of a bounded size. Each shard is one
task's unit: it is tokenised, gets a BM25 inverted index over its token ids, and is
packed greedily. A window starts with a seed document; the index returns the
seed's unused neighbours, best first, which fill the window; the document that
no longer fits is cut, and its rest seeds the next window. So every
window of a shard is full except the last, whose tokens go to sequences of
power-of-two lengths, which need no padding either.
"""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import with_defaults
from bazaar.llm.word_bpe import loaded

VOCABULARY = "word_bpe_49k.json"
END = 2                 # closes every document
WINDOW = 4096           # tokens of a full sequence; a power of two
SHARD_BYTES = 8 << 20   # text a shard holds on average
QUERY_TERMS = 16        # a seed's most telling terms are its query
K1, B = 1.2, 0.75

class Bm25:
    """Inverted index over a shard's documents (arrays of term ids)."""

    def __init__(self, docs: list[np.ndarray]) -> None:
        n = len(docs)
        length = np.array([len(d) for d in docs], np.float64)
        terms, tf = [], []
        for d in docs:
            t, c = np.unique(d, return_counts=True)
            terms.append(t)
            tf.append(c)
        sizes = np.array([len(t) for t in terms])
        doc = np.repeat(np.arange(n), sizes)
        term, count = np.concatenate(terms), np.concatenate(tf).astype(np.float64)
        df = np.bincount(term)
        self.idf = np.log1p((n - df + 0.5) / (df + 0.5))
        weight = self.idf[term] * count * (K1 + 1) / (count + K1 * (1 - B + B * length[doc] / length.mean()))
        # each document's query: its terms of the largest weight
        self.query = []
        ends = np.cumsum(sizes)
        for i, e in enumerate(ends):
            w = weight[e - sizes[i]:e]
            top = np.argpartition(-w, QUERY_TERMS)[:QUERY_TERMS] if len(w) > QUERY_TERMS else np.arange(len(w))
            self.query.append(terms[i][top])
        order = np.argsort(term, kind="stable")
        self.doc, self.weight = doc[order], weight[order]
        self.at = np.concatenate([[0], np.cumsum(df)])
        self.n = n

    def scores(self, i: int) -> np.ndarray:
        spans = [slice(self.at[t], self.at[t + 1]) for t in self.query[i]]
        return np.bincount(np.concatenate([self.doc[s] for s in spans]),
                           np.concatenate([self.weight[s] for s in spans]), self.n)


def neighbours(index: Bm25, i: int, unused: np.ndarray):
    """The unused documents with a positive score, best first (ties: in order)."""
    scores = np.where(unused, index.scores(i), 0)
    found = np.flatnonzero(scores > 0)
    if len(found) > 64:     # the best few are mostly enough
        floor = np.partition(scores[found], len(found) - 32)[len(found) - 32]
        best = found[scores[found] >= floor]
        yield from best[np.argsort(-scores[best], kind="stable")].tolist()
        found = found[scores[found] < floor]
    yield from found[np.argsort(-scores[found], kind="stable")].tolist()


def pack_shard(docs: list[np.ndarray], window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of a shard's documents."""
    n = len(docs)
    index = Bm25(docs)
    unused = np.ones(n, bool)
    pieces, chain, upcoming, room = [], [], 0, window

    def place(i: int, start: int) -> int:
        """Puts as much of a document as fits; returns where its rest starts."""
        nonlocal room
        length = min(room, len(docs[i]) - start)
        pieces.append((i, start, length))
        room = (room - length) or window
        return start + length

    left = int(n)
    rest: tuple[int, int] | None = None     # a cut document that goes on
    while left or rest:
        if rest:
            seed, start = rest
            rest = None
        else:
            while not unused[upcoming]:
                upcoming += 1
            seed, start = upcoming, 0
            unused[seed] = False
            left -= 1
        while start < len(docs[seed]):
            start = place(seed, start)
        if room == window or not left:
            continue
        for j in neighbours(index, seed, unused):
            unused[j] = False
            left -= 1
            done = place(j, 0)
            if done < len(docs[j]):
                rest = (j, done)
            if rest or room == window:
                break
    # offsets; the last, unfilled window goes to power-of-two sequences
    out, total = [], sum(len(d) for d in docs)
    full = total - total % window
    limits = list(range(window, full + 1, window))
    at = full
    for bit in reversed(range(window.bit_length())):
        if total % window >> bit & 1:
            at += 1 << bit
            limits.append(at)
    place_at, seq, begin = 0, 0, 0
    for i, start, length in pieces:
        while length:
            part = min(length, limits[seq] - place_at)
            out.append((i, start, part, seq, place_at - begin))
            start, length, place_at = start + part, length - part, place_at + part
            if place_at == limits[seq]:
                begin, seq = limits[seq], seq + 1
    return out


SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW,
         shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every id of every document (its text's ids, then END) lies in exactly one
    piece. NULL, empty and blank texts are END alone. Repeated rows are packed each.
    A document longer than a window spans several. ``window`` is a power of two.
    One shard is a task's unit; a document is never split over shards,
    so a longer one makes its shard as large as itself.
    """
    with open(path or public_tokenizers.path(VOCABULARY), encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    docs = with_defaults(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    docs = docs.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)))

    def run(table: pa.Table) -> pa.Table:
        texts = table.column("text").to_pylist()
        ids = table.column("doc_id").to_pylist()
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, texts[i]))
        tokens = loaded(spec.value).encode([texts[i] for i in order], END)
        base = table.column("shard")[0].as_py() << 32
        rows = [(ids[order[i]], start, length, zlib.crc32(tokens[i][start:start + length].tobytes()),
                 len(tokens[i]), base + seq, offset)
                for i, start, length, seq, offset in pack_shard(tokens, window)]
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        return pa.table({c: pa.array(x, pa.int64()) for c, x in zip(names, zip(*rows))})
    return docs.groupBy("shard").applyInArrow(run, SCHEMA)
