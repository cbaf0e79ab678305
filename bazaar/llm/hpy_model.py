"""Hierarchical Pitman-Yor language model over the corpus.

Restaurants: one per previous word (the document start is one more), all children of one
root restaurant over words, whose base distribution gives an unseen word a share estimated
from the words seen once. Tables of a child are customers of the root, so
contexts share what the root learns; a previous word never seen backs off to the root alone.

The (previous word, word) counts lie in a square grid of cells, dealt by the hashes of both
words, so a hot previous word and a hot word spread over a row and a column of cells, and the
grid grows with the corpus. Each entry's number of tables is kept from sweep to sweep. A sweep
draws it anew given the other tables of its context (the totals less its own) and the root's
probability of its word, all entries at once against the totals of the sweep before. The
conditional is exact up to EXACT customers (generalised Stirling numbers); of a larger entry,
the first EXACT customers are drawn so, and the others join in blocks with binomial draws. Cells
send their sums of tables to the row's and the column's totals, which come back in the
cells' own order; a few numbers of the root reach the driver. Entries of one customer
have one table always. Draws are seeded by (cell, sweep): a lost task repeats the
same draws. The score averages the predictive probabilities of the kept sweeps.

The corpus is tokenised once, into blocks of documents with their distinct words. A block
asks the cells for its distinct pairs of words, and gets their probabilities.
"""

from __future__ import annotations

import math
import struct
import uuid
import zlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm.common import map_arrow, materialize, with_defaults
from bazaar.llm.textops import U64, word_chunks

SWEEPS = 4              # Gibbs sweeps; the first BURN_IN are not averaged
BURN_IN = 1
BLOCK_BYTES = 20 << 20  # text per block, about (one longer text is a block of its own)
CELLS = 1.0             # cells per block, at least
EXACT = 256             # customers of an entry up to which its tables are drawn from their exact conditional
STRENGTH = 1.0          # strength of every restaurant
_LOW = 5                # low bits of a word hash that are left out
END = U64(0x9D39247E33776D41) >> U64(_LOW) << U64(_LOW)
START = U64(2**64 - 1) >> U64(_LOW) << U64(_LOW)      # the previous word of a document's first

_BLOCK_SCHEMA = "block long, docs binary, held binary, bounds binary, tokens binary, vocab binary"


def _pack(a: np.ndarray) -> bytes:
    """Unsigned 32-bit integers by byte planes, compressed."""
    planes = a.astype(np.uint32).view(np.uint8).reshape(-1, 4).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), "zstd", asbytes=True)


def _unpack(raw: bytes, count: int) -> np.ndarray:
    if not count:
        return np.empty(0, np.int32)
    planes = np.frombuffer(pa.decompress(raw, 4 * count, "zstd", asbytes=True), np.uint8).reshape(4, count)
    return np.ascontiguousarray(planes.T).view(np.int32)[:, 0]


def encode_blocks(docs: DataFrame, modulus: int, held: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks of documents: ids, held-out marks, token bounds, tokens as positions in the block's
    distinct words (frequent ones first), and these words' hashes. The end
    token closes each document."""
    def run(batches):
        ids, marks, tokens, sizes, volume = [], [], [], [], 0

        def flush():
            vocab, at, n = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
            order = np.argsort(-n, kind="stable")
            place = np.empty(len(order), np.uint32)
            place[order] = np.arange(len(order), dtype=np.uint32)
            vocab, at = vocab[order], place[at]
            bounds = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int64)
            known = [i if i is not None else 0 for i in ids]
            null = np.array([i is None for i in ids])
            docs_raw = np.concatenate([np.array(known, np.int64), null.astype(np.int64)])
            row = (uuid.uuid4().int & (2**63 - 1), docs_raw.tobytes(), np.array(marks, np.uint8).tobytes(),
                   bounds.tobytes(), _pack(at), vocab.tobytes())
            names = [c.split()[0] for c in _BLOCK_SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], pa.int64() if i == 0 else pa.binary()) for i, v in enumerate(row)], names)
        for batch in batches:
            column = batch.column("doc_id").cast(pa.int64()).to_pylist()
            for words in word_chunks(batch.column("text")):
                n = np.diff(words.bounds)
                out = np.full(len(words.hashes) + len(n), END)
                keep = np.ones(len(out), bool)
                keep[words.bounds[1:] + np.arange(len(n))] = False
                out[keep] = words.hashes >> U64(_LOW) << U64(_LOW)
                here = column[words.first:words.first + len(n)]
                ids += here
                marks += [zlib.crc32(b"" if i is None else str(i).encode()) % modulus == held for i in here]
                tokens.append(out)
                sizes.append(n + 1)
                volume += 6 * len(out)
                if volume >= block_bytes:
                    yield flush()
                    ids, marks, tokens, sizes, volume = [], [], [], [], 0
        if ids:
            yield flush()
    return docs.mapInArrow(run, _BLOCK_SCHEMA)


@dataclass
class Block:
    docs: np.ndarray
    null: np.ndarray
    held: np.ndarray
    bounds: np.ndarray
    tokens: np.ndarray
    words: int              # distinct words

    @staticmethod
    def read(row: dict) -> Block:
        docs = np.frombuffer(row["docs"], np.int64).reshape(2, -1)
        bounds = np.frombuffer(row["bounds"], np.int64)
        tokens = _unpack(row["tokens"], int(bounds[-1]))
        return Block(docs[0], docs[1] > 0, np.frombuffer(row["held"], np.uint8) > 0, bounds, tokens, len(row["vocab"]) // 8)


@dataclass
class Settings:
    words: int                  # V, distinct training words
    tokens: int                 # N, training tokens
    discount: float             # of the context restaurants
    root_discount: float
    unseen: float               # base share of an unseen word


@lru_cache(maxsize=4)
def _log_stirling(discount: float, most: int) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers S(n, t): seatings of n customers at t tables."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[1, 1] = 0.0
    for n in range(1, most):
        t = np.arange(1, n + 1)
        out[n + 1, 1:n + 1] = np.logaddexp(out[n, :n], np.log(n - discount * t) + out[n, 1:n + 1])
        out[n + 1, n + 1] = out[n, n]
    return out


def resample(n: np.ndarray, rest: np.ndarray, p: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of entries of n customers, given ``rest`` other tables in the restaurant and the parent's probability p.

    P(t) is in proportion to S(n, t) p^t times the weights STRENGTH + discount * (rest + k) of the t openings.
    """
    first = np.minimum(n, EXACT)
    table = _log_stirling(discount, EXACT)
    out, u = np.minimum(n, 1).astype(np.float64), rng.random(len(n))
    order = np.argsort(first, kind="stable")
    sizes, begin = np.unique(first[order], return_index=True)
    for m, i, j in zip(sizes.tolist(), begin, np.append(begin[1:], len(n))):
        for at in range(i, j, max(1, (1 << 20) // max(m, 1))) if m > 1 else ():
            some = order[at:min(j, at + (1 << 20) // m)]
            opened = np.log(p[some, None] * (STRENGTH + discount * (rest[some, None] + np.arange(m))))
            weight = table[m, 1:m + 1] + np.cumsum(opened, 1)
            weight = np.cumsum(np.exp(weight - weight.max(1, keepdims=True)), 1)
            out[some] = 1 + (weight < u[some, None] * weight[:, -1:]).sum(1)
    live, seated = np.flatnonzero(n > EXACT), first.astype(np.float64)
    while len(live):
        m, t = seated[live], out[live]
        size = np.minimum(np.floor(m / 32), n[live] - m)
        fresh = (STRENGTH + discount * (rest[live] + t)) * p[live]
        out[live] = t + rng.binomial(size.astype(np.int64), fresh / (fresh + m - discount * t))
        seated[live] = m + size
        live = live[seated[live] < n[live]]
    return out


def _dump(*arrays: np.ndarray) -> bytes:
    """Arrays by byte planes, compressed."""
    out = []
    for a in arrays:
        planes = np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.dtype.itemsize).T
        raw = pa.compress(np.ascontiguousarray(planes).tobytes(), "zstd", asbytes=True) if len(a) else b""
        out.append(struct.pack("<4sqq", a.dtype.str.encode(), len(a), len(raw)) + raw)
    return b"".join(out)


def _load(raw: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(raw):
        kind, count, size = struct.unpack_from("<4sqq", raw, at)
        at += struct.calcsize("<4sqq")
        dtype = np.dtype(kind.rstrip(b"\0").decode())
        if count:
            planes = np.frombuffer(pa.decompress(raw[at:at + size], count * dtype.itemsize, "zstd", asbytes=True), np.uint8)
            out.append(np.ascontiguousarray(planes.reshape(dtype.itemsize, count).T).view(dtype)[:, 0])
        else:
            out.append(np.empty(0, dtype))
        at += size
    return out


def _steps(a: np.ndarray) -> np.ndarray:
    """Differences of an ascending array (the first from 0), which compress better."""
    out = a.copy()
    out[1:] -= a[:-1]
    return out


def _rows(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(fields)],
                                      [name for name, _ in fields])


def _slot(hashes: np.ndarray, side: int) -> np.ndarray:
    """The row or column of the grid, by ranges of the hash."""
    return ((hashes >> U64(32)) * U64(side) >> U64(32)).astype(np.int64)


@dataclass
class Pairs:
    """The distinct (previous word, word) pairs of a block, by cell and then by both hashes."""
    block: Block
    place: np.ndarray       # each token's pair
    prev: np.ndarray        # hashes
    word: np.ndarray
    cells: np.ndarray       # the cells with pairs
    bounds: np.ndarray      # their pairs

    @staticmethod
    def read(row: dict, side: int) -> Pairs:
        b = Block.read(row)
        vocab = np.frombuffer(row["vocab"], np.int64).view(U64)
        order = np.argsort(vocab)
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        hashes = np.append(vocab[order], START)
        tokens = rank[b.tokens]
        prev = np.empty_like(tokens)
        prev[1:] = tokens[:-1]
        prev[b.bounds[:-1]] = len(order)
        slot = _slot(hashes, side).astype(np.int32)
        place = np.empty(len(tokens), np.int32)
        prevs, words, cells, bounds, done = [], [], [], [], 0
        line = slot[prev]
        for i in range(side):       # a row of the grid at a time keeps the sorts small
            here = np.flatnonzero(line == i)
            code, at = np.unique(prev[here].astype(np.int64) * len(order) + tokens[here], return_inverse=True)
            first, second = code // len(order), code % len(order)
            by = np.argsort(slot[second], kind="stable")
            to = np.empty(len(by), np.int32)
            to[by] = np.arange(done, done + len(by), dtype=np.int32)
            place[here] = to[at]
            column, begin = np.unique(slot[second][by], return_index=True)
            prevs.append(hashes[first[by]])
            words.append(hashes[second[by]])
            cells.append(i * side + column)
            bounds.append(done + begin)
            done += len(by)
        return Pairs(b, place, np.concatenate(prevs), np.concatenate(words), np.concatenate(cells),
                     np.append(np.concatenate(bounds), done))


_PIECE = "cell int, block long, piece binary"


def _pieces(blocks: DataFrame, side: int) -> DataFrame:
    """Each block's pairs and training counts, cut by cell."""
    def run(batch):
        for row in batch.to_pylist():
            pairs = Pairs.read(row, side)
            train = np.repeat(~pairs.block.held, np.diff(pairs.block.bounds))
            n = np.bincount(pairs.place[train], minlength=len(pairs.prev))
            for cell, i, j in zip(pairs.cells.tolist(), pairs.bounds, pairs.bounds[1:]):
                prev, runs = np.unique(pairs.prev[i:j], return_counts=True)
                word, at = np.unique(pairs.word[i:j], return_inverse=True)
                yield _rows(_PIECE, [(cell, row["block"], _dump(
                    _steps(prev), runs.astype(np.uint32), _steps(word), at.astype(np.uint32), n[i:j].astype(np.uint32)))])
    return map_arrow(blocks, run, _PIECE)


_CELL = "cell int, block long, pairs binary, asked binary, entries long, one long, two long"


def _cells(pieces: DataFrame) -> DataFrame:
    """Per cell: its distinct pairs (contexts, entries per context, words, word and count of an entry) and the
    counts of counts; and per block, which entries its pairs are."""
    def run(table: pa.Table) -> pa.Table:
        cell = table.column("cell")[0].as_py()
        blocks = table.column("block").to_pylist()
        loaded = []
        for raw in table.column("piece"):
            prev, runs, word, at, n = _load(raw.as_py())
            loaded.append((np.cumsum(prev, dtype=U64), runs, np.cumsum(word, dtype=U64), at, n))
        prevs, words = (np.unique(np.concatenate([p[k] for p in loaded])) for k in (0, 2))
        codes = [np.repeat(np.searchsorted(prevs, p[0]), p[1]) * len(words) + np.searchsorted(words, p[2])[p[3]] for p in loaded]
        code, at = np.unique(np.concatenate(codes), return_inverse=True)
        n = np.bincount(at, np.concatenate([p[4] for p in loaded]), len(code)).astype(np.int64)
        runs = np.bincount(code // len(words), minlength=len(prevs)).astype(np.uint32)
        rows = [(cell, None, _dump(_steps(prevs), runs, _steps(words), (code % len(words)).astype(np.uint32), n), None,
                 int((n > 0).sum()), int((n == 1).sum()), int((n == 2).sum()))]
        begin = 0
        for block, c in zip(blocks, codes):
            rows.append((cell, block, None, _dump(_steps(at[begin:begin + len(c)].astype(np.uint32))), None, None, None))
            begin += len(c)
        return pa.Table.from_batches([_rows(_CELL, rows)])
    return pieces.groupBy("cell").applyInArrow(run, _CELL)


def _entries_of(raw: bytes):
    """Hashes of a cell's contexts and words, and each entry's context, word and count."""
    prevs, runs, words, word, n = _load(raw)
    return (np.cumsum(prevs, dtype=U64), np.cumsum(words, dtype=U64), np.repeat(np.arange(len(prevs)), runs), word, n)


def _sums(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(at, values, size).astype(np.int64)


_AXIS = "axis int, cell int, place binary, customers binary, entries binary, total long, words long, one long, two long, a double, b double"


def _axes(cells: DataFrame, side: int) -> DataFrame:
    """Per row of the grid (axis below ``side``) and column, and each of its cells: the places of the cell's contexts
    or words in the axis, and their customers and distinct entries in the whole axis. The first cell's row
    also has the axis's totals: customers, those with any, with one, with two, and two sums for the unseen share."""
    sent = "axis int, cell int, keys binary, customers binary, entries binary"

    def send(batch):
        for cell, raw in zip(batch.column("cell").to_pylist(), batch.column("pairs").to_pylist()):
            prevs, words, prev, word, n = _entries_of(raw)
            some = (n > 0).astype(np.float64)
            yield _rows(sent, [(cell // side, cell, _dump(_steps(prevs)), _dump(_sums(prev, n, len(prevs))), _dump(_sums(prev, some, len(prevs)))),
                               (side + cell % side, cell, _dump(_steps(words)), _dump(_sums(word, n, len(words))), _dump(_sums(word, some, len(words))))])

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["cell"])
        keys = [np.cumsum(_load(r["keys"])[0], dtype=U64) for r in rows]
        _, at = np.unique(np.concatenate(keys), return_inverse=True)
        at = np.split(at, np.cumsum([len(k) for k in keys])[:-1])
        size = max(int(a.max()) for a in at) + 1
        n, e = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for r, a in zip(rows, at):
            n[a] += _load(r["customers"])[0]
            e[a] += _load(r["entries"])[0]
        totals = (int(n.sum()), int((n > 0).sum()), int((n == 1).sum()), int((n == 2).sum()),
                  float((n / (STRENGTH + n)).sum()), float((n * e / (STRENGTH + n)).sum()))
        return pa.Table.from_batches([_rows(_AXIS, [
            (r["axis"], r["cell"], _dump(_steps(a.astype(np.uint32))), _dump(n[a]), _dump(e[a]), *(totals if k == 0 else [None] * 6))
            for k, (r, a) in enumerate(zip(rows, at))])])
    own = cells.where("pairs is not null").select("cell", "pairs")
    return map_arrow(own, send, sent).groupBy("axis").applyInArrow(run, _AXIS)


def _corpus_settings(cells: DataFrame, axes: DataFrame, side: int) -> Settings:
    """As ``settings``, over the restaurants of all previous words."""
    e = cells.agg(F.sum("entries"), F.sum("one"), F.sum("two")).first()
    by = {r["context"]: r for r in axes.groupBy((F.col("axis") < side).alias("context")).agg(
        *[F.sum(c).alias(c) for c in ("total", "words", "one", "two", "a", "b")]).collect()}    # two rows

    def discount(one: int, two: int) -> float:
        return min(0.95, max(0.05, one / max(1, one + 2 * two)))
    c, w = by.get(True), by.get(False)
    if not w or not w["total"]:
        return Settings(0, 0, 0.5, 0.5, 1.0)
    d, d0 = discount(e[1], e[2]), discount(w["one"], w["two"])
    share = (STRENGTH * c["a"] + d * c["b"]) / w["total"]
    new = (STRENGTH + d0 * w["words"]) / (STRENGTH + e[0])
    unseen = min(0.99, max(0.01, w["one"] / w["total"] / max(1e-12, share * new)))
    return Settings(w["words"], w["total"], d, d0, unseen)


@dataclass
class Root:
    """The root's customers and tables."""
    customers: float
    tables: float


def _root(customers: np.ndarray, tables: np.ndarray, root: Root, s: Settings) -> np.ndarray:
    """The root's probability of words; one without customers is the unseen word."""
    new = STRENGTH + s.root_discount * root.tables
    p = (customers - s.root_discount * tables + new * (1 - s.unseen) / max(1, s.words)) / (STRENGTH + root.customers)
    return np.where(customers > 0, p, new * s.unseen / (STRENGTH + root.customers))


_DOWN = "axis int, cell int, sums binary, customers long, tables long"


def _down(axes: DataFrame, up: DataFrame | None, root: Root, s: Settings, side: int, sweep: int) -> tuple[DataFrame, Root]:
    """Per axis and cell: the tables of its contexts, or its words' root customers and tables; and the root's totals.

    ``up`` has the cells' sums of tables; without it every entry has one table."""
    base = (1 - s.unseen) / max(1, s.words)

    def answer(axis: int, cells: list, places: list, sums: np.ndarray) -> pa.Table:
        if axis < side:
            out, totals = [_dump(sums[a].astype(np.uint32)) for a in places], (None, None)
        else:
            # a word's own tables hardly count among the root's
            tables = resample(sums, np.full(len(sums), max(0.0, root.tables - 1)), np.full(len(sums), base), s.root_discount,
                              np.random.default_rng([sweep, 1, axis]))
            out = [_dump(sums[a].astype(np.uint32), tables[a].astype(np.uint32)) for a in places]
            totals = int(sums.sum()), int(tables.sum())
        return pa.Table.from_batches([_rows(_DOWN, [
            (axis, c, o, *(totals if k == 0 else (None, None))) for k, (c, o) in enumerate(zip(cells, out))])])

    def run(left: pa.Table, right: pa.Table | None = None) -> pa.Table:
        cells = left.column("cell").to_pylist()
        places = [np.cumsum(_load(r.as_py())[0], dtype=np.int64) for r in left.column("place")]
        sums = np.zeros(max(int(a.max()) for a in places) + 1, np.int64)
        if right is None:
            for a, raw in zip(places, left.column("entries")):
                sums[a] = _load(raw.as_py())[0]
        else:
            sent = dict(zip(right.column("cell").to_pylist(), right.column("sums").to_pylist()))
            for c, a in zip(cells, places):
                sums[a] += _load(sent[c])[0]
        return answer(left.column("axis")[0].as_py(), cells, places, sums)
    if up is None:
        out = axes.select("axis", "cell", "place", "entries").groupBy("axis").applyInArrow(lambda t: run(t), _DOWN)
    else:
        out = (axes.select("axis", "cell", "place").groupBy("axis")
               .cogroup(up.groupBy("axis")).applyInArrow(lambda x, y: run(x, y), _DOWN))
    out = materialize(out, "tables")
    r = out.agg(F.sum("customers"), F.sum("tables")).first()
    return out, Root(float(r[0] or 0), float(r[1] or 0))


_ACTIVE = "cell int, part binary, fixed binary"
_SEATED = "cell int, axis int, t binary, sums binary"


def _active(cells: DataFrame) -> DataFrame:
    """Per cell: its entries of more than one customer (context, word, count), and the tables of the others."""
    def run(batch):
        for cell, raw in zip(batch.column("cell").to_pylist(), batch.column("pairs").to_pylist()):
            prevs, words, prev, word, n = _entries_of(raw)
            live, one = np.flatnonzero(n > 1), (n == 1).astype(np.float64)
            yield _rows(_ACTIVE, [(cell, _dump(_steps(prev[live].astype(np.uint32)), word[live], n[live]),
                                   _dump(_sums(prev, one, len(prevs)).astype(np.uint32), _sums(word, one, len(words)).astype(np.uint32)))])
    return map_arrow(cells.where("pairs is not null").select("cell", "pairs"), run, _ACTIVE)


def _seated(active: DataFrame, before: DataFrame | None, down: DataFrame, root: Root, s: Settings, side: int, sweep: int) -> DataFrame:
    """A sweep: per cell the tables of its active entries, and its sums of tables for its row and its column.

    ``before`` has the entries' tables after the last sweep; without it every entry has one."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        own = left.to_pylist()[0]
        cell = own["cell"]
        prev, word, n = _load(own["part"])
        prev = np.cumsum(prev, dtype=np.int64)
        by_prev, by_word = _load(own["fixed"])
        rows = right.to_pylist()
        tables, p = _answers([r for r in rows if r["t"] is None], root, s, side)
        past = next((_load(r["t"])[0] for r in rows if r["t"] is not None), np.ones(len(n)))
        t = resample(n, tables[prev] - past, p[word], s.discount, np.random.default_rng([sweep, 0, cell]))
        sums = [(cell // side, by_prev + _sums(prev, t, len(by_prev))), (side + cell % side, by_word + _sums(word, t, len(by_word)))]
        return pa.Table.from_batches([_rows(_SEATED, [(cell, None, _dump(t.astype(np.uint32)), None)] + [
            (cell, axis, None, _dump(v.astype(np.int64))) for axis, v in sums])])
    facts = down.select("cell", "axis", "sums", F.lit(None).cast("binary").alias("t"))
    if before is not None:
        facts = facts.unionByName(before.where("t is not null").select("cell", "axis", "sums", "t"))
    return active.groupBy("cell").cogroup(facts.groupBy("cell")).applyInArrow(run, _SEATED)


def _answers(rows: list[dict], root: Root, s: Settings, side: int) -> tuple[np.ndarray, np.ndarray]:
    """The tables of a cell's contexts and the root's probability of its words."""
    by = {r["axis"] < side: _load(r["sums"]) for r in rows}
    customers, tables = (a.astype(np.float64) for a in by[False])
    return by[True][0].astype(np.float64), _root(customers, tables, root, s)


_ANSWER = "block long, cell int, p binary, counts binary"


def _probabilities(cells: DataFrame, axes: DataFrame, kept: list, s: Settings, side: int) -> DataFrame:
    """Per block and cell: the probability of each of its pairs (float32), averaged over the kept sweeps, and the
    training counts of the piece's words. ``kept``: (tables of the contexts and the root, tables of the entries, root)."""
    right = axes.select("cell", "axis", F.lit(-1).alias("sweep"), F.col("customers").alias("sums"), F.lit(None).cast("binary").alias("t"))
    for k, (down, seated, _) in enumerate(kept):
        right = right.unionByName(down.select("cell", "axis", F.lit(k).alias("sweep"), "sums", F.lit(None).cast("binary").alias("t")))
        right = right.unionByName(seated.where("t is not null").select(
            "cell", "axis", F.lit(k).alias("sweep"), F.lit(None).cast("binary").alias("sums"), "t"))
    roots = [root for _, _, root in kept]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, facts = left.to_pylist(), right.to_pylist()
        _, _, prev, word, n = _entries_of(next(r["pairs"] for r in rows if r["pairs"] is not None))
        by = {r["axis"] < side: _load(r["sums"])[0] for r in facts if r["sweep"] < 0}
        customers, counts = by[True][prev], by[False]
        p = np.zeros(len(n))
        for k, root in enumerate(roots):
            now = [r for r in facts if r["sweep"] == k]
            t = np.minimum(n, 1).astype(np.float64)
            t[n > 1] = _load(next(r["t"] for r in now if r["t"] is not None))[0]
            tables, base = _answers([r for r in now if r["t"] is None], root, s, side)
            p += (n - s.discount * t + (STRENGTH + s.discount * tables[prev]) * base[word]) / (STRENGTH + customers)
        p = (p / len(roots)).astype(np.float32)
        out = []
        for r in rows:
            if r["block"] is not None:
                at = np.cumsum(_load(r["asked"])[0], dtype=np.int64)
                out.append((r["block"], r["cell"], _dump(p[at]), _dump(counts[np.unique(word[at])])))
        return pa.Table.from_batches([_rows(_ANSWER, out)])
    return (cells.select("cell", "block", "pairs", "asked").groupBy("cell")
            .cogroup(right.groupBy("cell")).applyInArrow(run, _ANSWER))


_SCORE_SCHEMA = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                 "base_score double, score double")


def _score_blocks(blocks: DataFrame, answers: DataFrame, s: Settings, side: int) -> DataFrame:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        pairs = Pairs.read(left.to_pylist()[0], side)
        b = pairs.block
        got = {r["cell"]: r for r in right.to_pylist()}
        p, count = np.empty(len(pairs.prev)), np.empty(len(pairs.prev), np.int64)
        for cell, i, j in zip(pairs.cells.tolist(), pairs.bounds, pairs.bounds[1:]):
            p[i:j] = _load(got[cell]["p"])[0]
            _, at = np.unique(pairs.word[i:j], return_inverse=True)
            count[i:j] = _load(got[cell]["counts"])[0][at]
        del got
        pairs.prev = pairs.word = None
        begin = b.bounds[:-1]
        score = np.add.reduceat(np.log10(p)[pairs.place], begin)
        base = np.add.reduceat(np.log10((count + 1) / (s.tokens + s.words + 1))[pairs.place], begin)
        known = np.add.reduceat((count > 0)[pairs.place].astype(np.int64), begin)
        return pa.table({
            "doc_id": pa.array(b.docs, pa.int64(), mask=b.null), "held_out": pa.array(b.held),
            "n_tokens": pa.array(np.diff(b.bounds)), "n_known": pa.array(known),
            "train_tokens": pa.array(np.full(len(begin), s.tokens, np.int64)),
            "base_score": pa.array(base), "score": pa.array(score)})
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, _SCORE_SCHEMA)


def score_corpus(docs: DataFrame, modulus: int = 7, held: int = 2, sweeps: int = SWEEPS,
                 burn_in: int = BURN_IN) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from all documents whose crc32(doc_id as text) mod ``modulus`` is not ``held``. Tokens
    are the words (A-Z lower-cased) and one end token. base_score is the add-one unigram's
    log10 probability, score the model's; both treat all unseen words as one type.
    Perplexity is 10 ** (-score / n_tokens). Words are compared by 59-bit hashes.

    NULL and empty texts are the end token alone. Repeated rows are learned and scored each; other
    columns are ignored. Without a training document every word is unseen.
    """
    docs = with_defaults(docs, "doc_id", "text")
    blocks = materialize(encode_blocks(docs, modulus, held), "token-blocks")
    side = max(1, math.ceil(math.sqrt(CELLS * blocks.count())))
    cells = materialize(_cells(_pieces(blocks, side)), "word-pairs")
    axes = materialize(_axes(cells, side), "axes")
    s = _corpus_settings(cells, axes, side)
    active = materialize(_active(cells), "active-pairs")
    down, root = _down(axes, None, Root(s.words, s.words), s, side, 0)
    kept, seated = [], None
    for sweep in range(1, sweeps + 1):
        seated = materialize(_seated(active, seated, down, root, s, side, sweep), "seated-pairs")
        down, root = _down(axes, seated.where("axis is not null").select("axis", "cell", "sums"), root, s, side, sweep)
        if sweep > burn_in:
            kept.append((down, seated, root))
    return _score_blocks(blocks, _probabilities(cells, axes, kept, s, side), s, side)
