"""Spelling variants grouped through a dictionary of trie-node pairs.

The nodes of a trie over the words and of a trie over the reversed words are numbered.
A word with one letter skipped, and a word cut in two, are then a pair of integers:
(node of the prefix, node of the suffix). Two words with the same pair of skips differ in
the skipped letter; a skip of one word that equals a cut of another is an insertion. Equal
pairs are equal strings, so the join on them gives the exact neighbours of one edit.

A pair is shared by at most as many skips as there are letters, whatever the corpus, and
by one cut. A group is summed up where it is found (neighbours counted, the most frequent
one named); neighbour pairs are never written.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import materialize, with_defaults

MIN_LENGTH = 5          # letters of a word
MIN_COUNT = 3           # its occurrences
GARBLED = 97            # one (document, run) of so many loses a letter
_RUN = re.compile("[a-zÀ-ÿ]+")
_BASE = 91              # 26 + 64 letters, and none: digits of a path
_PATH = 9               # nodes up to this depth are numbered by their path, which fits in 63 bits
_HELD = 200_000         # counted words held by a task before it passes them on
_ROWS = 200_000         # pairs made at once
_NONE = np.iinfo(np.int64).max


def runs_of(doc_id: int | None, text: str | None, garbled: int = GARBLED) -> Counter:
    """Occurrences of every lower-cased letter run of a text, after the deletions."""
    found = Counter(_RUN.findall(text.encode().lower().decode())) if text else Counter()
    start = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
    out = Counter()
    for run, n in found.items():
        h = zlib.crc32(run.encode(), start)
        if h % garbled == 0:
            i = h % len(run)
            run = run[:i] + run[i + 1:]
        out[run] += n
    return out


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                garbled: int = GARBLED) -> DataFrame:
    """(word, n) of the words of whole texts, counted before the shuffle."""
    def run(batches):
        held: Counter = Counter()

        def rows():
            out = pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return out
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for word, n in runs_of(doc_id, text.as_py(), garbled).items():
                    if len(word) >= min_length:
                        held[word] += n
                if len(held) > _HELD:
                    yield rows()
        yield rows()

    rows = docs.where("text is not null").mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _deep_nodes(words: DataFrame, key: str, out: str) -> DataFrame:
    """Adds ``out``: the numbers of the nodes of ``key`` deeper than a path number reaches.

    Words that share such a node share their first letters, so they meet in one task; in
    sorted order a node is new where a word leaves the one before it. Only the word
    before is held. Numbers are negative, path numbers are not.
    """
    names = words.columns

    def run(batches):
        before, path, number = "", [], -1 - (TaskContext.get().partitionId() << 40)
        for batch in batches:
            paths = []
            for word in batch.column(names.index(key)).to_pylist():
                same = 0
                for a, b in zip(before, word):
                    if a != b:
                        break
                    same += 1
                kept = path[:max(0, same - _PATH)]
                more = len(word) - _PATH - len(kept)
                path = kept + list(range(number, number - more, -1))
                number -= more
                before = word
                paths.append(path)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(paths, pa.list_(pa.int64()))], [*names, out])

    dealt = words.repartition(F.substring(key, 1, _PATH)).sortWithinPartitions(key)
    schema = ", ".join(f"{n} {t}" for n, t in words.dtypes)
    return dealt.mapInArrow(run, f"{schema}, {out} array<long>")


def _paths(letters: np.ndarray, deep: list | None) -> np.ndarray:
    """Node numbers, by depth from 0, of words given as rows of letter numbers."""
    n, length = letters.shape
    out = np.zeros((n, length + 1), np.int64)
    for d in range(min(length, _PATH)):
        out[:, d + 1] = out[:, d] * _BASE + letters[:, d]
    if length > _PATH:
        out[:, _PATH + 1:] = deep
    return out


def _node_pairs(words: DataFrame) -> DataFrame:
    """(prefix, suffix, rank, kind) of every cut (kind 0) and skip (2, or 1 if the letter before
    is the same: skipping either gives one string) of words with ``forward`` and ``backward`` nodes."""
    def run(batches):
        for batch in batches:
            by_length: dict[int, list] = {}
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                by_length.setdefault(len(row[0]), []).append(row)
            for length, rows in by_length.items():
                step = max(1, _ROWS // (2 * length + 1))
                for at in range(0, len(rows), step):
                    yield pairs(length, *zip(*rows[at:at + step]))

    def pairs(length, words, ranks, forward, backward):
        letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(-1, length).astype(np.int64)
        letters = np.where(letters < 128, letters - 96, letters - 0xC0 + 27)
        pre = _paths(letters, forward)
        suf = _paths(letters[:, ::-1], backward)[:, ::-1]       # by the letter at which the suffix begins
        kind = np.ones((len(words), length), np.int8)
        kind[:, 0] = 2
        kind[:, 1:] += letters[:, 1:] != letters[:, :-1]
        rank = np.array(ranks, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (
            (pre.ravel(), pre[:, :-1].ravel()), (suf.ravel(), suf[:, 1:].ravel()),
            (np.repeat(rank, length + 1), np.repeat(rank, length)),
            (np.zeros(suf.size, np.int8), kind.ravel()))], ["prefix", "suffix", "rank", "kind"])

    return words.select("word", "rank", "forward", "backward").mapInArrow(
        run, "prefix long, suffix long, rank long, kind byte")


def summed_groups(prefix: np.ndarray, suffix: np.ndarray, rank: np.ndarray, kind: np.ndarray) -> tuple:
    """(rank, neighbours, smallest rank among them) of the members of whole groups, sorted by group."""
    start = np.ones(len(rank), bool)
    start[1:] = (prefix[1:] != prefix[:-1]) | (suffix[1:] != suffix[:-1])
    alone = start & np.append(start[1:], True)
    start, rank, kind = start[~alone], rank[~alone], kind[~alone]
    if not len(rank):
        return rank, rank, rank
    at, group = np.flatnonzero(start), np.cumsum(start) - 1

    def least(where):
        return np.minimum.reduceat(np.where(where, rank, _NONE), at)[group]

    skip, whole, first = kind > 0, kind == 0, kind == 2
    top = least(skip)
    second = least(skip & (rank != top))
    cut = least(whole)
    skips = np.add.reduceat(skip.astype(np.int64), at)[group]
    firsts = np.add.reduceat(first.astype(np.int64), at)[group]
    n = np.where(whole, firsts, skips - 1 + (first & (cut != _NONE)))
    best = np.where(whole, least(first), np.minimum(np.where(rank == top, second, top), np.where(first, cut, _NONE)))
    seen = n > 0
    return rank[seen], n[seen], best[seen]


def _neighbours(pairs: DataFrame) -> DataFrame:
    """(rank, n_near, best) of the words that have neighbours; best is the smallest rank near."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            cols = [c.to_numpy() for c in batch.columns]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            p, s = cols[:2]
            last = int(np.flatnonzero((p != p[-1]) | (s != s[-1]))[-1]) + 1 if (p[0], s[0]) != (p[-1], s[-1]) else 0
            held = [c[last:] for c in cols]         # the last group may go on: as many rows as there are letters
            yield out([c[:last] for c in cols])
        if held is not None:
            yield out(held)

    def out(cols):
        return pa.RecordBatch.from_arrays([pa.array(x) for x in summed_groups(*cols)], ["rank", "n", "best"])

    dealt = pairs.repartition("prefix", "suffix").sortWithinPartitions("prefix", "suffix")
    return (dealt.mapInArrow(run, "rank long, n long, best long")
            .groupBy("rank").agg(F.sum("n").alias("n_near"), F.min("best").alias("best")))


def _roots(links: DataFrame) -> DataFrame:
    """(rank, root) by doubling: a form is twice as frequent, so chains are as long as a count has bits."""
    links = materialize(links, "spelling-links")
    while True:
        on = links.select(F.col("rank").alias("to"), F.col("to").alias("next"))
        links = materialize(links.join(on, "to", "left").select(
            "rank", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")), "spelling-links")
        if links.where("moved").isEmpty():
            return links.select("rank", F.col("to").alias("root"))
        links = links.select("rank", "to")


def near_words(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of a table (word, n) of distinct words of the letters a-z and
    U+00C0 to U+00FF."""
    ranked = materialize(words.select("word", "n").orderBy(F.desc("n"), "word")
                         .withColumn("rank", F.monotonically_increasing_id()), "spelling-words")
    nodes = F.lit(None).cast("array<long>")
    short = ranked.where(F.length("word") <= _PATH).select("word", "rank", nodes.alias("forward"), nodes.alias("backward"))
    deep = ranked.where(F.length("word") > _PATH).select("word", "rank", F.reverse("word").alias("drow"))
    deep = _deep_nodes(_deep_nodes(deep, "word", "forward"), "drow", "backward").select(*short.columns)
    near = _neighbours(_node_pairs(short).unionByName(_node_pairs(deep)))

    best = ranked.select(F.col("rank").alias("best"), F.col("word").alias("best_word"), F.col("n").alias("best_n"))
    found = ranked.join(near, "rank", "left").join(best, "best", "left")
    form = F.col("best_n") >= 2 * F.col("n")
    found = materialize(found.select(
        "rank", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(form, F.col("best")).alias("to"),
        F.when(form, F.col("best_word")).alias("form"), F.when(form, F.col("best_n")).alias("form_n")), "spelling-forms")
    roots = _roots(found.where("to is not null").select("rank", "to"))
    names = ranked.select(F.col("rank").alias("root"), F.col("word").alias("root_word"))
    return (found.join(roots.join(names, "root").select("rank", "root_word"), "rank", "left")
            .select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n"))


def spelling_groups(docs: DataFrame) -> DataFrame:
    """One row per word of the documents: word, form, root, n, n_near, form_n.

    A form is the most frequent word at one edit (ties: smallest in code-point order) if it
    is at least twice as frequent; a root is where the forms lead. NULL and empty texts have no
    words, a NULL id counts as empty text in the deletions, repeated rows count each,
    extra columns are ignored, an empty table gives no rows. Runs may be of any length.
    """
    return near_words(word_counts(with_defaults(docs, "doc_id", "text")))
