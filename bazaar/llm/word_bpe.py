"""Vectorised encoding with a lower-casing word BPE (``tokenizers`` JSON).

The vocabulary drops white space, lower-cases, and cuts a text into pieces: letter
runs, single digits, runs of other characters, and English contractions. Pieces
are found and hashed by numpy over many texts at once; each distinct piece is
merged once, all pieces of one length together. Texts of ASCII and Latin-1
letters go this way; other texts are encoded by the library itself.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

from bazaar.llm.bpe import byte_alphabet
from bazaar.llm.merge_table import Merges
from bazaar.llm.textops import U64, mix, span_hashes

_CHUNK_BYTES = 1 << 20
_LONG = 48                      # longer pieces are left to the library

# kinds of bytes in a plain text: 0 white space, 1 letter, 2 digit, 3 other
_KIND = np.full(256, 3, np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
_KIND[0x30:0x3A] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_CODE = mix(np.arange(256, dtype=np.uint64) * U64(0xD6E8FEB86659FD93) + U64(0x9F4A7C15))

# What the vectorised way leaves to the library: characters beyond Latin-1's letters
# (with the signs of multiplication and division), controls, and special tokens.
_ODD = re.compile("[^\t-\r -\x7fÀ-ÖØ-öø-ÿ]|<\\|")


class WordBpe:
    def __init__(self, spec: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        model = json.loads(spec)["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        self.first = np.zeros(256, np.int64)    # id of a byte inside a piece
        self.last = np.zeros(256, np.int64)     # id of a piece's last byte
        for c, b in byte_alphabet().items():
            self.first[b], self.last[b] = vocab[c], vocab[c + suffix]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges = Merges([(vocab[a], vocab[b], vocab[a + b]) for a, b in merges], max(vocab.values()) + 1)

    def _pieces(self, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the pieces of plain lower-cased texts, and their hashes."""
        kind = _KIND[raw]
        n = len(raw)
        cut = np.zeros(n + 1, bool)
        cut[bounds] = True
        start = np.ones(n, bool)
        start[1:] = (kind[1:] != kind[:-1]) | cut[1:n] | (kind[1:] == 2)
        marks = np.flatnonzero((raw == 0x27) & start)       # apostrophes that begin a piece
        if len(marks):
            at = lambda k: np.where((marks + k < n) & ~cut[np.minimum(marks + k, n)], raw[np.minimum(marks + k, n - 1)], 0)
            one, two = at(1), at(2)
            two = np.where(one > 0, two, 0)
            short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
            long = np.zeros(len(marks), bool)
            for pair in (b"re", b"ve", b"ll"):
                long |= (one == pair[0]) & (two == pair[1])
            for found, size in ((marks[short], 2), (marks[long], 3)):
                start[found + 1] = False
                after = found[found + size < n] + size
                start[after] = True
        s = np.flatnonzero(start)
        e = np.append(s[1:], n)
        keep = kind[s] > 0
        s, e = s[keep], e[keep]
        return s, e, span_hashes(_CODE[raw], s, e)

    def _plain(self, texts: list[str], end: int) -> list[np.ndarray]:
        raw = np.frombuffer("".join(texts).encode(), np.uint8)
        sizes = [len(t) if t.isascii() else len(t.encode()) for t in texts]
        bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        low = _LOWER[raw]
        if not all(map(str.isascii, texts)):    # the second byte of Latin-1's capitals
            second = np.flatnonzero(raw[:-1] == 0xC3) + 1
            second = second[low[second] < 0x9F]
            low[second] += 0x20
        starts, ends, hashes, first = [], [], [], [0]
        i = 0
        while i < len(texts):
            j = min(len(texts), max(i + 1, int(np.searchsorted(bounds, bounds[i] + _CHUNK_BYTES, "right")) - 1))
            a, b = bounds[i], bounds[j]
            if b > a:
                s, e, h = self._pieces(low[a:b], bounds[i:j + 1] - a)
                starts.append(s + a)
                ends.append(e + a)
                hashes.append(h)
            i = j
        if not starts:
            return [np.array([end], np.uint32)] * len(texts)
        s, e = np.concatenate(starts), np.concatenate(ends)
        _, index, inverse = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
        us, ul = s[index], (e - s)[index]
        made, width = [], np.zeros(len(index), np.int64)
        for size in np.unique(ul):
            which = np.flatnonzero(ul == size)
            if size > _LONG:
                for w in which:
                    piece = low[us[w]:us[w] + size].tobytes().decode()
                    ids = np.array([self.tokenizer.encode(piece, add_special_tokens=False).ids], np.int64)
                    made.append((which[which == w], ids))
                    width[w] = ids.shape[1]
                continue
            for at in range(0, len(which), 1 << 15):
                part = which[at:at + (1 << 15)]
                letters = low[us[part][:, None] + np.arange(size)]
                ids = self.first[letters]
                ids[:, -1] = self.last[letters[:, -1]]
                for rows, done in self.merges.merged(ids) if size > 1 else [(np.arange(len(part)), ids)]:
                    made.append((part[rows], done))
                    width[part[rows]] = done.shape[1]
        where = np.concatenate([[0], np.cumsum(width)])
        flat = np.empty(where[-1], np.uint32)
        for rows, ids in made:
            flat[where[rows][:, None] + np.arange(ids.shape[1])] = ids
        # all texts' ids: each piece's run of `flat`, END after each text
        size = width[inverse]
        closed = np.searchsorted(s, bounds)                     # pieces before each text
        begin = np.concatenate([[0], np.cumsum(size)])
        source = np.arange(begin[-1]) + np.repeat(where[inverse] - begin[:-1], size)
        ids = flat[source]
        cuts = begin[closed]
        tail = np.array([end], np.uint32)
        return [np.concatenate([ids[cuts[i]:cuts[i + 1]], tail]) for i in range(len(texts))]

    def encode(self, texts: list[str], end: int) -> list[np.ndarray]:
        """The ids of each text, with the id ``end`` behind."""
        odd = [bool(_ODD.search(t)) for t in texts]
        out = iter(self._plain([t for t, o in zip(texts, odd) if not o], end))
        strange = iter(self.tokenizer.encode_batch([t for t, o in zip(texts, odd) if o], add_special_tokens=False))
        return [np.array(next(strange).ids + [end], np.uint32) if o else next(out) for o in odd]


_LOADED: dict[int, WordBpe] = {}


def loaded(spec: str) -> WordBpe:
    """The worker's encoder for a tokenizer file's text, built once."""
    key = hash(spec)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = WordBpe(spec)
    return _LOADED[key]
