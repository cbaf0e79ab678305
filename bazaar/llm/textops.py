"""Vectorised word hashing over Arrow text columns.

Words are the runs of bytes other than 0x20 and 0x09-0x0D; none of these
occurs inside a multi-byte UTF-8 character, so bytes are enough. A-Z count as
a-z. A word's hash is a polynomial over its bytes (prefix sums modulo 2^64,
shifted back by the inverse power), then mixed with its length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_CHUNK_BYTES = 1 << 20  # text handled at once; one longer text is a chunk of its own


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (array in, new array out)."""
    x = x ^ (x >> U64(33))
    x *= U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[0x41:0x5B] += U64(0x20)
_BYTE = mix(_LOWER * U64(0xD6E8FEB86659FD93) + U64(0x2545F4914F6CDD1D))


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, _CHUNK_BYTES + 1)
            inverse = pow(_BASE, -1, 1 << 64)
            for name, base in (("up", _BASE), ("down", inverse)):
                a = np.full(size, base, U64)
                a[0] = 1
                setattr(self, name, np.cumprod(a, dtype=U64))
        return self.up, self.down


_POWERS = _Powers()


@dataclass
class Words:
    """Word hashes of consecutive texts; ``bounds[i]:bounds[i+1]`` are text i's."""
    first: int            # index of the first text in its batch
    hashes: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def of(self, i: int) -> np.ndarray:
        return self.hashes[self.bounds[i]:self.bounds[i + 1]]


def span_hashes(codes: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Hashes of the spans ``codes[s[i]:e[i]]`` of a sequence of 64-bit codes."""
    n = len(codes)
    up, down = _POWERS.get(n + 1)
    sums = np.empty(n + 1, U64)
    sums[0] = 0
    np.cumsum(codes * up[:n], out=sums[1:])
    return mix((sums[e] - sums[s]) * down[s] + (e - s).astype(U64) * U64(0xA0761D6478BD642F))


def hash_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts ``data[offsets[i]:offsets[i+1]]`` and
    the word index at which each text begins."""
    base = int(offsets[0])
    data, offsets = data[base:int(offsets[-1])], offsets - base
    n = len(data)
    if n == 0:
        return np.empty(0, U64), np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    cut = np.zeros(n + 1, bool)           # a text begins here
    cut[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | cut[1:n]
    stop = inside.copy()                  # last byte of a word
    stop[:-1] &= ~inside[1:] | cut[1:n]
    s, e = np.flatnonzero(start), np.flatnonzero(stop) + 1
    return span_hashes(_BYTE[data], s, e), np.searchsorted(s, offsets)


def hash_text(text: str) -> np.ndarray:
    """The word hashes of one text."""
    raw = np.frombuffer(text.encode(), np.uint8)
    return hash_words(raw, np.array([0, len(raw)]))[0]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; NULL counts as empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset:column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)), offsets


def word_chunks(column: pa.Array, chunk_bytes: int = _CHUNK_BYTES) -> Iterator[Words]:
    """Word hashes of a text column, a bounded number of bytes at a time."""
    data, offsets = text_buffers(column)
    i, n = 0, len(column)
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + chunk_bytes, "right")) - 1)
        j = min(j, n)
        hashes, bounds = hash_words(data, offsets[i:j + 1])
        yield Words(i, hashes, bounds)
        i = j


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word windows; a shorter non-empty
    sequence is one shingle; no words, none."""
    n = len(words)
    if n == 0:
        return np.empty(0, U64)
    width = min(k, n)
    h = np.full(n - width + 1, width, U64)
    for j in range(width):
        h = mix(h * U64(0x9FB21C651E98DF25) + words[j:n - width + 1 + j])
    return np.unique(h)
