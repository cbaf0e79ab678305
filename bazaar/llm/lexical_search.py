"""Ranked lexical search by an Aho-Corasick scan of the documents.

There is no index: the terms of the items, guarded by blanks on both sides, form one
automaton that every task builds from a broadcast term list, and each document is run
through it as it is read. A first scan gives the corpus figures and document
frequencies, a second one the scores; automaton outputs map to the items that hold
the term. Tasks keep their best documents per item, which a two-level top k merges.

Items are dealt to blocks of a bounded number of (item, term) pairs, so that what is
broadcast is bounded at any number of items: each block is two scans.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.llm.common import materialize, with_defaults
from bazaar.llm.textops import text_buffers

PAIRS = 200_000         # (item, term) pairs of one broadcast block; a single larger item is a block of its own
_CELLS = 1_000_000      # scores and additions to them held at once in a task, beyond one document
_HELD = 500_000         # candidates gathered before a task cuts them to its best k per item
_MERGE = 64             # salts of the first merging level
_NOBODY = np.iinfo(np.int64).max    # stands for a NULL id, which ranks behind all others

#: Bytes of a text to bytes of its scan form: A-Z lowered, every separator a blank.
_FORM = bytes(b if b >= 0x80 else ord(chr(b).lower()) if chr(b).isalnum() else 0x20 for b in range(256))


def scan_forms(column: pa.Array) -> Iterator[bytes]:
    """The scan form of every text of a column (NULL: empty)."""
    data, offsets = text_buffers(column)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        yield data[a:b].tobytes().translate(_FORM)


def automaton(terms: list[bytes]) -> ahocorasick.Automaton:
    """Finds every blank-guarded term; outputs are positions in ``terms``."""
    out = ahocorasick.Automaton()
    for k, term in enumerate(terms):
        out.add_word(f" {term.decode('latin-1')} ", k)
    out.make_automaton()
    return out


def scan(column: pa.Array, found: ahocorasick.Automaton) -> Iterator[tuple[int, Counter]]:
    """(number of terms, occurrences by position of the automaton's terms) of every text."""
    for form in scan_forms(column):
        n = len(form.split())
        hits = Counter([k for _, k in found.iter(f" {form.decode('latin-1')} ")]) if n else Counter()
        yield n, hits


def item_terms(items: DataFrame) -> DataFrame:
    """(item_no, item_id, term) once per term of every item row; item_no numbers the rows."""
    def run(batches):
        for batch in batches:
            sets = [sorted(set(form.split())) for form in scan_forms(batch.column(2))]
            rows = np.repeat(np.arange(batch.num_rows), [len(s) for s in sets])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows),
                 pa.array([t for s in sets for t in s], pa.binary())], ["item_no", "item_id", "term"])

    rows = items.select(F.monotonically_increasing_id().alias("item_no"), "item_id", "text")
    return rows.mapInArrow(run, T.StructType([
        T.StructField("item_no", T.LongType()), items.schema["item_id"], T.StructField("term", T.BinaryType())]))


def _blocks(pairs: DataFrame, bound: int) -> list[DataFrame]:
    """``pairs`` in parts of at most ``bound`` rows, or of one item."""
    total, most = pairs.groupBy("item_no").count().agg(F.sum("count"), F.max("count")).first()
    if not total:
        return []
    n = math.ceil(total / bound)
    while n > 1:
        n += n // 2
        parts = pairs.groupBy(F.pmod(F.xxhash64("item_no"), F.lit(n)).alias("part"))
        worst = parts.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("item_no").alias("items")) \
            .where("items > 1").agg(F.max("n")).first()[0]
        if worst is None or worst <= bound:
            break
    part = F.pmod(F.xxhash64("item_no"), F.lit(n))
    return [pairs.where(part == i) for i in range(n)] if n > 1 else [pairs]


def _corpus_counts(docs: DataFrame, terms: list[bytes]) -> tuple[int, int, np.ndarray]:
    """(documents with terms, all their terms, documents per term) by one scan."""
    def run(batches):
        found, df = automaton(terms), np.zeros(len(terms) + 2, np.int64)
        for batch in batches:
            for n, hits in scan(batch.column(0), found):
                df[list(hits)] += 1
                df[-2:] += (n > 0, n)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], ["at", "n"])

    df = np.zeros(len(terms) + 2, np.int64)     # as bounded as the block's term list
    for at, n in docs.select("text").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n")).collect():
        df[at] = n
    return int(df[-2]), int(df[-1]), df[:-2]


class _Best:
    """The best k (score, id) per item among the candidates added so far."""

    def __init__(self, items: int, k: int) -> None:
        self.k, self.parts, self.held = k, [], 0
        self.floor = np.ones(items, np.int64)       # a candidate below cannot be among the best

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray) -> None:
        self.parts.append(np.stack([item, score, doc]))
        self.held += len(item)
        if self.held > _HELD + 2 * self.k * len(self.floor):
            self.cut()

    def cut(self) -> np.ndarray:
        rows = np.concatenate(self.parts, axis=1) if self.parts else np.empty((3, 0), np.int64)
        rows = rows[:, np.lexsort((rows[2], -rows[1], rows[0]))]
        first = np.searchsorted(rows[0], rows[0])
        place = np.arange(rows.shape[1]) - first
        last = rows[:, place == self.k - 1]
        self.floor[last[0]] = last[1]
        rows = rows[:, place < self.k]
        self.parts, self.held = [rows], rows.shape[1]
        return rows


def _task_best(docs: DataFrame, terms: list[bytes], weights: np.ndarray, of_term: list[np.ndarray],
               items: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item_no, score, doc_id, task) of every task's best documents per item."""
    spread = np.array([len(x) for x in of_term], np.int64)

    def flush(best, ids, sizes, hits):
        term, tf = np.concatenate(hits, axis=1)
        doc = np.repeat(np.arange(len(ids)), [h.shape[1] for h in hits])
        m = 100 - 50 + np.array([50 * n * n_docs // n_terms for n in sizes], np.int64)[doc]
        gain = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
        scores = np.zeros(len(ids) * len(items), np.int64)
        at = np.repeat(doc * len(items), spread[term]) + np.concatenate([of_term[t] for t in term])
        np.add.at(scores, at, np.repeat(gain, spread[term]))
        scores = scores.reshape(len(ids), len(items))
        d, i = np.nonzero(scores >= best.floor)
        best.add(i, scores[d, i], np.array(ids, np.int64)[d])

    def run(batches):
        found, best = automaton(terms), _Best(len(items), k)
        ids, sizes, hits, cells = [], [], [], 0
        for batch in batches:
            for doc_id, (n, seen) in zip(batch.column(0).to_pylist(), scan(batch.column(1), found)):
                if not seen:
                    continue
                ids.append(_NOBODY if doc_id is None else doc_id)
                sizes.append(n)
                hits.append(np.array([list(seen), list(seen.values())], np.int64))
                cells += len(items) + int(spread[hits[-1][0]].sum())
                if cells >= _CELLS:
                    flush(best, ids, sizes, hits)
                    ids, sizes, hits, cells = [], [], [], 0
        if ids:
            flush(best, ids, sizes, hits)
        item, score, doc = best.cut()
        yield pa.RecordBatch.from_arrays(
            [pa.array(items[item]), pa.array(score), pa.array(doc, mask=doc == _NOBODY)], ["item_no", "score", "doc_id"])

    return (docs.select("doc_id", "text").mapInArrow(run, "item_no long, score long, doc_id long")
            .withColumn("task", F.spark_partition_id() % _MERGE))


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 50, pairs_bound: int = PAIRS) -> DataFrame:
    """The ``k`` best documents of every item: item_id, rank, doc_id, score.

    Terms, weights and the integer score are those of the contract. A NULL or empty text
    has no terms: such a document is never ranked and does not count, such an item has no rows.
    Repeated document rows rank one after another, repeated item rows have a ranking
    each, NULL ids rank behind equal scores. Extra columns are ignored. An empty table
    on either side gives no rows.
    """
    docs = with_defaults(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    docs = docs.where("text is not null")
    pairs = materialize(item_terms(with_defaults(items, "item_id", "text")), "search-items")
    best = []
    for block in _blocks(pairs, pairs_bound):
        held = block.select("item_no", "term").toArrow()
        if not held.num_rows:       # a part no item was dealt to
            continue
        coded = held.column("term").combine_chunks().dictionary_encode()
        terms = coded.dictionary.to_pylist()
        items_here, item_at = np.unique(held.column("item_no").to_numpy(), return_inverse=True)
        order = np.argsort(coded.indices.to_numpy(), kind="stable")
        of_term = np.split(item_at[order], np.cumsum(np.bincount(coded.indices.to_numpy(), minlength=len(terms)))[:-1])
        n_docs, n_terms, df = _corpus_counts(docs, terms)
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        if n_docs:
            best.append(_task_best(docs, terms, weights, of_term, items_here, n_docs, n_terms, k))
    names = pairs.select("item_no", "item_id").distinct()
    if not best:
        return names.select("item_id", F.lit(1).alias("rank"), F.lit(0).cast("long").alias("doc_id"),
                            F.lit(0).cast("long").alias("score")).where("false")
    rows = best[0]
    for more in best[1:]:
        rows = rows.unionByName(more)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    for keys in (["item_no", "task"], ["item_no"]):
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
    return rows.join(names, "item_no").select("item_id", "rank", "doc_id", "score")
