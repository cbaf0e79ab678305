"""Byte-pair encoding with forced boundaries, and decoding.

A byte pair that occurs inside no vocabulary token can never lie inside an
encoded token, so it marks a certain cut: the fragments between such cuts (and
between the pre-tokeniser's pieces) are encoded independently and their ids
concatenated. Words repeat, so each worker keeps what it has encoded; the new ones of
many texts are cut and merged together by numpy.

The tokenizer file (``tokenizers`` JSON, byte-level BPE) is a parameter. Spark
ships the file's text to the tasks with the function, so executors
need no such file; its size is that of one vocabulary.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
import string

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from bazaar.llm.common import map_arrow, with_defaults
from bazaar.llm.merge_table import Merges

VOCABULARY = "byte_bpe_50k.json"
_MEMO = 500_000     # remembered chunks and fragments per worker
_SLICE = 256        # documents per output batch at most
_CHARS = 1 << 20    # their characters, beyond one document
_WIDE = 64          # longer fragments are merged one by one

# An optional space and a run of non-spaces, or white space as the pre-tokeniser's pattern
# takes it: every match is a union of whole pieces.
_CHUNK = re.compile(r" ?\S+|\s+(?!\S)|\s+")
# Signs that follow a word as one piece; not the apostrophe, which may begin a contraction.
_SIGNS = string.punctuation.replace("'", "")
# White space to Python's re, but not to the pre-tokeniser.
_ODD_SPACE = re.compile("[\x1c-\x1f]")


def byte_alphabet() -> dict[str, int]:
    """The printable character of each byte, as byte-level vocabularies write it."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Memo(dict):
    """A bounded dictionary that computes what it misses.

    Two generations of at most half the limit each: when the young one is full
    it becomes the old one, and what is still in use moves over again.
    """

    def __init__(self, make, limit: int = _MEMO) -> None:
        super().__init__()
        self.make, self.half, self.old = make, max(1, limit // 2), {}

    def __missing__(self, key):
        value = self.old.get(key)
        return self.put(key, self.make(key) if value is None else value)

    def put(self, key, value):
        if len(self) >= self.half:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class ByteBpe:
    """Encoder and decoder of one byte-level BPE vocabulary."""

    def __init__(self, spec: str) -> None:
        j = json.loads(spec)
        alphabet = byte_alphabet()
        raw = lambda t: bytes(alphabet[c] for c in t)
        vocab = j["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in j["added_tokens"] if t["special"]}
        self.token = {i: raw(t) for t, i in vocab.items() if t not in self.special}
        self.token.update((i, t.encode()) for t, i in self.special.items())
        self.byte_id = [0] * 256
        for c, b in alphabet.items():
            self.byte_id[b] = vocab[c]
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, m in enumerate(j["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.merge[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.inside = {p for t in self.token.values() for p in zip(t, t[1:])}   # pairs inside a token
        self.is_inside = np.zeros(1 << 16, bool)
        self.is_inside[[a << 8 | b for a, b in self.inside]] = True
        self.ids_of_bytes = np.array(self.byte_id, np.int64)
        self.merges = Merges([(a, b, made) for (a, b), (_, made) in self.merge.items()], max(vocab.values()) + 1)
        self.piece = regex.compile(public_tokenizers.PATTERN)
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.fragments = Memo(self._merge)
        self.chunks = Memo(self._chunk)

    def cuts(self, raw: bytes) -> list[bytes]:
        """The fragments between forced boundaries."""
        inside = self.inside
        at = [i for i, p in enumerate(zip(raw, raw[1:]), 1) if p not in inside]
        return [raw[i:j] for i, j in zip([0, *at], [*at, len(raw)])] if at else [raw]

    def _merge(self, raw: bytes) -> list[int]:
        """Ids of a fragment: the lowest-ranked pair is merged until none is left."""
        ids = [self.byte_id[b] for b in raw]
        if len(ids) > 200:
            return self._merge_long(ids)
        get, none = self.merge.get, (1 << 30, -1)
        pairs = [get(p, none) for p in zip(ids, ids[1:])]
        while pairs:
            best = min(pairs)
            if best is none:
                break
            i = pairs.index(best)
            ids[i:i + 2] = [best[1]]
            del pairs[i]
            if i:
                pairs[i - 1] = get((ids[i - 1], ids[i]), none)
            if i < len(pairs):
                pairs[i] = get((ids[i], ids[i + 1]), none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same for a long fragment: a heap of pairs over a linked list."""
        import heapq
        n, merge = len(ids), self.merge
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m[0], i, ids[i], ids[i + 1]) for i in range(n - 1) if (m := merge.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = merge[a, b][1], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (m := merge.get((ids[x], ids[y]))):
                    heapq.heappush(heap, (m[0], x, ids[x], ids[y]))
        return [t for t in ids if t >= 0]

    def _encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Ids of many single pieces: cut at forced boundaries together, merged by fragment length."""
        raw = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(w) for w in words])
        start = np.ones(len(raw), bool)
        start[1:] = ~self.is_inside[raw[:-1].astype(np.int64) << 8 | raw[1:]]
        start[ends[:-1]] = True
        s = np.flatnonzero(start)
        size = np.diff(np.append(s, len(raw)))
        made, width = [], np.ones(len(s), np.int64)
        for n in np.unique(size).tolist():
            which = np.flatnonzero(size == n)
            if n > _WIDE:
                done = [(which[i:i + 1], np.array([self._merge(raw[s[w]:s[w] + n].tobytes())], np.int64))
                        for i, w in enumerate(which)]
            else:
                ids = self.ids_of_bytes[raw[s[which][:, None] + np.arange(n)]]
                done = [(which[rows], ids) for rows, ids in self.merges.merged(ids)] if n > 1 else [(which, ids)]
            for rows, ids in done:
                width[rows] = ids.shape[1]
                made.append((rows, ids))
        at = np.concatenate([[0], np.cumsum(width)])
        flat = np.empty(at[-1], np.int64)
        for rows, ids in made:
            flat[at[rows][:, None] + np.arange(ids.shape[1])] = ids
        flat, cuts = flat.tolist(), at[np.searchsorted(s, np.concatenate([[0], ends]))].tolist()
        return [flat[i:j] for i, j in zip(cuts, cuts[1:])]

    def _answer(self, chunk: str, ids: list[int]) -> tuple[str, str, int]:
        text = self.decode(ids)
        return ",".join(map(str, ids)), chunk if text == chunk else text, len(ids)

    def _chunk(self, chunk: str) -> tuple[str, str, int]:
        """Decimal ids, decoded text and number of ids of a chunk."""
        if chunk in self.special:
            return self._answer(chunk, [self.special[chunk]])
        ids = []
        for piece in (chunk,) if self._is_word(chunk) else self.piece.findall(chunk):
            for f in self.cuts(piece.encode()):
                ids += self.fragments[f]
        return self._answer(chunk, ids)

    @staticmethod
    def _is_word(chunk: str) -> bool:
        """Whether a chunk is surely a single piece."""
        return chunk.isalpha() or (chunk[0] == " " and chunk[1:].isalpha())

    def _split(self, text: str) -> list[str]:
        """The chunks of a text in order; a special token is a chunk."""
        out = []
        for part in self.split.split(text) if self.split else [text]:
            if part in self.special:
                out.append(part)
            elif part:
                out += self.piece.findall(part) if _ODD_SPACE.search(part) else _CHUNK.findall(part)
        return out

    def parts(self, texts: list[str]) -> list[list[tuple[str, str, int]]]:
        """The answers of every text's chunks, in order; new words are encoded together."""
        split = [self._split(t) for t in texts]
        known = self.chunks
        new = {c for chunks in split for c in set(chunks) if c not in known}
        held, pieces = [], []
        for c in new:
            if c in known.old:
                known[c]
            elif c not in self.special:
                word = c.rstrip(_SIGNS)
                if not word or not self._is_word(word):
                    mine = self.piece.findall(c)
                else:
                    mine = [c] if len(word) == len(c) else [word, c[len(word):]]
                held.append((c, len(mine)))
                pieces += mine
        if held:
            ids = iter(self._encode_words([p.encode() for p in pieces]))
            for c, n in held:
                known.put(c, self._answer(c, next(ids) if n == 1 else [i for _ in range(n) for i in next(ids)]))
        return [list(map(known.__getitem__, chunks)) for chunks in split]

    def encode(self, text: str) -> list[int]:
        return [int(i) for p in self.parts([text])[0] for i in p[0].split(",")]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.token.__getitem__, ids)).decode("utf-8", "replace")

    def digests(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """(number of ids, SHA-256 of the decimal ids, SHA-256 of the decoded text) of every text."""
        return [(sum([p[2] for p in parts]), hashlib.sha256(",".join([p[0] for p in parts]).encode()).hexdigest(),
                 hashlib.sha256("".join([p[1] for p in parts]).encode()).hexdigest()) for parts in self.parts(texts)]

    def counts(self, texts: list[str]) -> list[tuple[int]]:
        """The number of ids of every text."""
        return [(sum([p[2] for p in parts]),) for parts in self.parts(texts)]


_LOADED: dict[int, ByteBpe] = {}


def loaded(spec: str) -> ByteBpe:
    """The worker's encoder for a tokenizer file's text, built once."""
    key = hash(spec)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = ByteBpe(spec)
    return _LOADED[key]


def read_spec(path: str | None = None) -> str:
    with open(path or public_tokenizers.path(VOCABULARY), encoding="utf-8") as f:
        return f.read()


def _per_text(docs: DataFrame, fn, schema: str, types: list[pa.DataType], path: str | None) -> DataFrame:
    """Rows of doc_id and ``fn(encoder, texts)``; NULL text counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(read_spec(path))
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batch):
        encoder = loaded(shared.value)
        ids, texts = batch.column("doc_id"), batch.column("text")
        at = 0
        while at < batch.num_rows:
            held, chars = [], 0
            while at + len(held) < batch.num_rows and len(held) < _SLICE and chars < _CHARS:
                held.append(texts[at + len(held)].as_py() or "")
                chars += len(held[-1])
            gc.disable()        # many small objects and no cycles: the collector would only walk the memo
            try:
                rows = fn(encoder, held)
            finally:
                gc.enable()
            yield pa.RecordBatch.from_arrays(
                [ids.slice(at, len(held)).cast(pa.int64()), *[pa.array(c, t) for c, t in zip(zip(*rows), types)]], names)
            at += len(held)
    return map_arrow(with_defaults(docs, "doc_id", "text"), run, schema)


def encode_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256.

    ids_sha256 is the SHA-256 of the decimal ids joined by commas,
    decoded_sha256 that of the decoded text. NULL and empty texts have no ids (the
    digests of the empty text). Special tokens spelled out in a text are
    encoded as such and kept in decoding. Repeated rows each give a row.
    """
    return _per_text(docs, ByteBpe.digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
                     [pa.int64(), pa.string(), pa.string()], path)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: doc_id and its ids as ``array<int>``; NULL and empty texts give an empty array."""
    return _per_text(docs, lambda e, texts: [(e.encode(t),) for t in texts], "doc_id long, ids array<int>", [pa.list_(pa.int32())], path)


def token_lengths(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: doc_id and n_tokens; NULL and empty texts have 0."""
    return _per_text(docs, ByteBpe.counts, "doc_id long, n_tokens long", [pa.int64()], path)
