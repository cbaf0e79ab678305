"""Interpolated Kneser-Ney character models of several classes in sorted hash arrays.

A word is scored as the symbols ``^ c1 .. cn $`` with contexts that end at its start, so
a word's log-probability is the same wherever it stands. Counting runs in Spark
(one row per class and n-gram); the arrays are built from the aggregated rows.

For each order k there are the sorted hashes of all n-grams seen in any class, with
log10 p(c | h) per class, and of all contexts, with the log10 backoff weight per
class. An n-gram that a class has not seen, under a context it has seen, has its
interpolated probability in the same row; so a lookup falls back only where no
class has seen the n-gram, or the context.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm.textops import U64, mix, span_hashes

_WORD = re.compile(r"[^\W\d_]+")        # runs of letters, and of numbers that are no digits
_LETTERS = regex.compile(r"\p{L}+")
_EDGE = 0                               # code of the word boundary symbol
UNSEEN = 1.0 / 50_000                   # floor of the uniform distribution over symbols
LONGEST = 64                            # longer runs of letters are scored in pieces of this size


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters; an overlong run counts as several."""
    out = _WORD.findall(text.lower()) if text else []
    if not all(map(str.isalpha, out)):
        out = [w for run in out for w in _LETTERS.findall(run)]
    if out and len(max(out, key=len)) > LONGEST:
        out = [w[i:i + LONGEST] for w in out for i in range(0, len(w), LONGEST)]
    return out


def symbols(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of ``^ c1 .. cn $`` of all words, one after the other, and where each word begins."""
    joined = "\0".join(words)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    # ^ and $ are one symbol, shared by neighbours: ^ w1 # w2 # ... wn $
    codes = np.concatenate([[_EDGE], codes, [_EDGE]]).astype(np.uint32)
    edges = np.flatnonzero(codes == _EDGE)
    return codes, edges


def ngrams(codes: np.ndarray, edges: np.ndarray, order: int):
    """For k = 1 .. order: (positions predicted, hash of the k-gram ending there, hash of
    its context). At a position near its word's start only the shorter k exist."""
    sym = mix((codes.astype(U64) + U64(1)) * U64(0x9E3779B97F4A7C15))
    since = np.arange(len(codes)) - edges[np.searchsorted(edges, np.arange(len(codes)), "left") - 1]
    since[0] = 0        # distance to the edge before a position; an edge predicts as $
    for k in range(1, order + 1):
        at = np.flatnonzero(since >= max(k - 1, 1))
        if not len(at):
            return
        yield k, at, span_hashes(sym, at - k + 1, at + 1), span_hashes(sym, at - k + 1, at)


def count_ngrams(rows: DataFrame, order: int) -> DataFrame:
    """(class, k, gram, context, shorter, n) of rows (class, text): counts of all n-grams.

    ``shorter`` is the hash of the n-gram without its first symbol.
    """
    def run(batches):
        for batch in batches:
            by_class: dict[int, dict[str, int]] = {}
            for c, t in zip(batch.column("class").to_pylist(), batch.column("text").to_pylist()):
                seen = by_class.setdefault(c, {})
                for w in words_of(t):
                    seen[w] = seen.get(w, 0) + 1
            for c, seen in by_class.items():
                if not seen:
                    continue
                words = list(seen)
                codes, edges = symbols(words)
                weight = np.array([seen[w] for w in words])
                word = np.searchsorted(edges, np.arange(len(codes)), "left") - 1
                short = np.zeros(len(codes), U64)
                for k, at, gram, context in ngrams(codes, edges, order):
                    g, first, inverse = np.unique(gram, return_index=True, return_inverse=True)
                    n = np.bincount(inverse, weight[word[at]]).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(g), c), pa.int32()), pa.array(np.full(len(g), k), pa.int32()),
                         pa.array(g.view(np.int64)), pa.array(context[first].view(np.int64)),
                         pa.array(short[at[first]].view(np.int64)), pa.array(n)],
                        ["class", "k", "gram", "context", "shorter", "n"])
                    short = np.zeros(len(codes), U64)
                    short[at] = gram
    return (rows.select(F.col("class").cast("int").alias("class"), "text")
            .mapInArrow(run, "class int, k int, gram long, context long, shorter long, n long")
            .groupBy("class", "k", "gram", "context", "shorter").agg(F.sum("n").alias("n")))


class HashTable:
    """Sorted 64-bit keys with a directory of their leading bits."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = keys                     # sorted, distinct
        self.bits = max(1, int(len(keys)).bit_length())
        self.start = np.searchsorted(keys >> U64(64 - self.bits), np.arange((1 << self.bits) + 1, dtype=U64))

    def find(self, h: np.ndarray) -> np.ndarray:
        """Row of each key, or -1."""
        b = (h >> U64(64 - self.bits)).astype(np.int64)
        at, end = self.start[b], self.start[b + 1]
        out = np.full(len(h), -1, np.int64)
        live = np.flatnonzero(at < end)
        while len(live):
            row = at[live]
            hit = self.keys[row] == h[live]
            out[live[hit]] = row[hit]
            live = live[~hit]
            at[live] += 1
            live = live[at[live] < end[live]]
        return out


@dataclass
class Model:
    """Per order: table and log10 p (n-grams), table and log10 backoff (contexts)."""
    classes: list
    order: int
    base: float                                        # log10 of an unseen symbol
    grams: list[tuple[HashTable, np.ndarray]]
    contexts: list[tuple[HashTable, np.ndarray] | None]

    def word_scores(self, words: list[str]) -> np.ndarray:
        """log10 p of each word in each class (float64, words x classes)."""
        codes, edges = symbols(words)
        p = np.full((len(codes), len(self.classes)), self.base)
        for k, at, gram, context in ngrams(codes, edges, self.order):
            if k > 1:
                table, weight = self.contexts[k - 1]
                row = table.find(context)
                seen = row >= 0
                p[at[seen]] += weight[row[seen]]
            table, logp = self.grams[k - 1]
            row = table.find(gram)
            seen = row >= 0
            p[at[seen]] = logp[row[seen]]
        sums = np.add.reduceat(p[1:], edges[:-1], axis=0)      # edge e opens the word at e + 1
        return sums


def build(counts: dict[str, np.ndarray], classes: list, order: int, shared: int = 0,
          discount: float = 0.75) -> Model:
    """The model of aggregated counts (columns class, k, gram, context, shorter, n).

    ``class`` holds positions in ``classes``. Orders up to ``shared`` use counts pooled over
    the classes: what a class has rarely seen is then smoothed alike in all.
    """
    m = len(classes)
    cls, k_of, n_of = counts["class"], counts["k"], counts["n"].astype(np.float64)
    gram, context, shorter = (counts[c].view(U64) for c in ("gram", "context", "shorter"))
    base = np.log10(UNSEEN)
    grams, contexts = [], []
    for k in range(1, order + 1):
        here = k_of == k
        keys, first, inverse = np.unique(gram[here], return_index=True, return_inverse=True)
        # the highest order uses counts, lower ones the number of distinct longer n-grams
        # (the n-grams at a word's start have no longer form and keep their counts)
        c = np.zeros((len(keys), m))
        c[inverse, cls[here]] = n_of[here]
        if k < order and (k_of == k + 1).any():
            longer = k_of == k + 1
            kinds = np.zeros((len(keys), m))
            np.add.at(kinds, (np.searchsorted(keys, shorter[longer]), cls[longer]), 1)
            c = np.where(kinds > 0, kinds, c)
        if k <= shared:
            c = np.repeat(c.sum(1, keepdims=True), m, 1)
        tables, at = np.unique(context[here][first], return_inverse=True)
        total, taken = np.zeros((2, len(tables), m))
        np.add.at(total, at, c)
        np.add.at(taken, at, np.minimum(c, discount))
        # a class that has never seen the context leaves everything to the lower order
        backoff = np.where(total > 0, taken / np.maximum(total, 1e-300), 1.0)
        lower = np.full((len(keys), m), UNSEEN)
        if k > 1:
            row = grams[-1][0].find(shorter[here][first])
            lower[row >= 0] = 10.0 ** grams[-1][1][row[row >= 0]].astype(np.float64)
        p = (c - np.minimum(c, discount)) / np.maximum(total[at], 1e-300) + backoff[at] * lower
        grams.append((HashTable(keys), np.log10(p).astype(np.float32)))
        contexts.append((HashTable(tables), np.log10(np.maximum(backoff, 1e-12)).astype(np.float32)) if k > 1 else None)
    return Model(list(classes), order, base, grams, contexts)


def collect_counts(counts: DataFrame) -> dict[str, np.ndarray]:
    """The aggregated counts as arrays, in a fixed order. The sample they are
    taken from is bounded by its parameters, and so are they."""
    table = counts.toArrow()
    cols = {c: table.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in table.column_names}
    order = np.lexsort((cols["gram"], cols["k"], cols["class"]))
    return {c: v[order] for c, v in cols.items()}


class WordScores:
    """Scores of words by a model, remembered up to a limit, and their sums per text."""

    def __init__(self, model: Model, limit: int = 400_000) -> None:
        self.model, self.limit = model, limit
        self.row: dict[str, int] = {}
        self.scores = np.zeros((1 << 12, len(model.classes)), np.float32)

    def rows(self, texts: list[list[str]]) -> list[np.ndarray]:
        """The rows of ``scores`` of each text's words; valid until the next call."""
        if len(self.row) > self.limit:
            self.row.clear()
        row = self.row
        fresh = [w for w in set().union(*texts) if w not in row]
        if fresh:
            at = len(row)
            while len(self.scores) < at + len(fresh):
                self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
            for i in range(0, len(fresh), 1 << 15):
                part = fresh[i:i + (1 << 15)]
                self.scores[at + i:at + i + len(part)] = self.model.word_scores(part)
            row.update(zip(fresh, range(at, at + len(fresh))))
        return [np.fromiter(map(row.__getitem__, t), np.int64, len(t)) for t in texts]


def score_rows(docs: DataFrame, keep: list[str], result: str, types: tuple, make, rate, prefix: str = "") -> DataFrame:
    """The ``keep`` columns of every row and the columns of ``result`` (DDL, names with ``prefix``):
    ``rate(make(), texts)`` gives one tuple per text. ``make`` runs once per task."""
    fields = [f.split() for f in result.split(", ")]
    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
                       + [f"`{prefix}{n}` {t}" for n, t in fields])
    names = [*keep, *[prefix + n for n, _ in fields]]

    def run(batches):
        state = make()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                cols = list(zip(*rate(state, part.column("text").to_pylist())))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in keep], *[pa.array(c, t) for c, t in zip(cols, types)]], names)
    return docs.select(*[f"`{c}`" for c in dict.fromkeys([*keep, "text"])]).mapInArrow(run, schema)
