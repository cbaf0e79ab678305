"""N-gram Jaccard join: exact links, components and link counts.

Every document is its set of distinct n-word shingles in one global order (the
order of their 64-bit hashes). The join runs in these steps:

1. **Copies.** Equal sets share a digest; from here on a digest is a node, and
   its copies are only counted. A hot group of copies is one node.
2. **Branches.** The hash range is cut into K equal ranges, the top branches of
   the prefix tree; a set's elements inside one range are one path below that
   branch. Linked sets of at most U elements differ in at most D elements, so
   with K > D at least one branch holds the *same whole path* for both. The path
   digests are joined; no link is lost, and a passage that many documents share
   costs little, as the rest of a path then differs. Weak paths (empty, or of one
   element) would meet by chance: K has slack for them, and a set with more
   weak paths than the slack allows emits those too.
3. **Candidates.** Sets that share a path are compared by their element counts
   in 128 hash ranges. The counts' L1 distance never exceeds the sets'
   difference, so this only removes pairs that cannot link. Paths shared by many
   sets are split into blocks, each pair of blocks a task's unit.
4. **Prefix tree.** Per probe set, the candidates are stored in a path-compressed
   trie. A traversal counts each shared run once for all sets below it and cuts a
   subtree when the overlap so far plus what can remain misses the bound.
5. **Two rounds.** Round one verifies, per path, only the pairs with a pivot drawn for
   that path; a group of near copies is connected by them. Round two looks for all remaining
   candidates *between different components* of round one. A pair is a candidate in the unit of
   the smallest path that both have; in later units it is passed over if that path is among
   the ``_KNOWN`` smallest of both. Short sets with a candidate are sent to the unit and
   verified there; a unit writes only links that join two
   components. Long sets, too large to send along every path, are verified as pairs. No
   pair that could join components is left out, and no group's pairs are ever written.
6. **Link counts.** All links lie inside components; each pair of blocks of a
   component's sets is multiplied out in one task, which returns sums only.

Sizes: K depends on the size class [L, U] of the larger set (U < 1.4 L); a set
whose partners can reach the next class emits its paths there too.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.llm.common import map_arrow, materialize, with_defaults
from bazaar.llm.graph import components
from bazaar.llm.textops import U64, mix, shingle_hashes, word_chunks

NGRAM = 4
PERCENT = 85          # a link: 100 * intersection >= PERCENT * union
_GROWTH = 1.4         # size classes grow by this factor
_CELLS = 128          # ranges of the count filter
_BLOCK = 1024         # sets compared at once within one shared path
_SHORT = 512          # elements of a set that is verified inside its units
_FAN = 256            # candidates per trie
_KNOWN = 32           # smallest shared paths that a set's rows carry, to tell where a pair has met


def size_class(n: int) -> int:
    return int(math.log(n) / math.log(_GROWTH) + 1e-9)


def class_bounds(c: int) -> tuple[int, int]:
    """Smallest and largest set size of class ``c`` (consistent with size_class)."""
    low = max(1, math.ceil(_GROWTH ** c) - 1)
    while size_class(low) < c:
        low += 1
    high = low
    top = math.ceil(_GROWTH ** (c + 1)) + 1
    for high in range(top, low - 1, -1):
        if size_class(high) <= c:
            break
    return low, max(low, high)


def max_difference(total: int, percent: int) -> int:
    """Largest symmetric difference of linked sets whose sizes add up to ``total``."""
    return (100 - percent) * total // (100 + percent)


class Branching:
    """Number of branches per size class."""

    def __init__(self, percent: int) -> None:
        self.percent = percent
        self._classes: dict[int, tuple[int, int, int]] = {}

    def of(self, c: int) -> tuple[int, int, int]:
        """(L, U, K) of class ``c``: K exceeds the largest difference by about as
        many branches as a set of L elements has weak ones."""
        if c not in self._classes:
            low, high = class_bounds(c)
            need = k = max_difference(2 * high, self.percent) + 1
            if need > 1:
                for _ in range(8):
                    share = math.exp(-low / k) * (1 + low / k)
                    k = min(2 * need, math.ceil(need + share * k + 2 * math.sqrt(share * k)))
            self._classes[c] = (low, high, k)
        return self._classes[c]


def path_digests(items: np.ndarray, percent: int, branching: Branching) -> np.ndarray:
    """Digests of the set's paths, for each size class in which it can be linked."""
    n = len(items)
    largest = 100 * n // percent
    c, out = size_class(n), []
    while True:
        low, high, k = branching.of(c)
        if low > largest:
            return np.concatenate(out)
        branch = ((items >> U64(32)) * U64(k)) >> U64(32)
        first = np.flatnonzero(np.r_[True, branch[1:] != branch[:-1]])
        length = np.diff(np.r_[first, n])
        seed = U64((c * 0x9E3779B97F4A7C15 + 0x1234567) & (2**64 - 1))
        path = mix(np.add.reduceat(mix(items), first) + mix(branch[first] + seed))
        strong = length > 1
        worst = max_difference(n + min(high, largest), percent)
        if int(strong.sum()) < k and k - int(strong.sum()) > k - 1 - worst:
            # too many weak paths: they may be the only equal ones
            strong[:] = True
            bare = np.setdiff1d(np.arange(k, dtype=U64), branch[first], assume_unique=True)
            out.append(mix(mix(bare + seed) ^ U64(0x5851F42D4C957F2D)))
        out.append(path[strong])
        c += 1


def _digest(items: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        h = mix(np.array([mix(items).sum(dtype=U64) + U64(len(items)) * U64(0xD6E8FEB86659FD93)], U64))
    return int(h.view(np.int64)[0])


def _cells(items: np.ndarray) -> bytes:
    counts = np.bincount((items >> U64(57)).astype(np.int64), minlength=_CELLS)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def _sets(docs: DataFrame, ngram: int) -> DataFrame:
    """(doc_id, key, n, dig, cells); ``docs`` has doc_id, text and key."""
    def run(batch):
        ids, keys = batch.column("doc_id"), batch.column("key")
        for words in word_chunks(batch.column("text")):
            size, digs, cells = [], [], []
            for i in range(len(words)):
                items = shingle_hashes(words.of(i), ngram)
                size.append(len(items))
                digs.append(_digest(items) if len(items) else None)
                cells.append(_cells(items) if len(items) else None)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(words.first, len(words)).cast(pa.int64()), keys.slice(words.first, len(words)),
                 pa.array(size, pa.int64()), pa.array(digs, pa.int64()), pa.array(cells, pa.binary())],
                ["doc_id", "key", "n", "dig", "cells"])
    return map_arrow(docs, run, "doc_id long, key long, n long, dig long, cells binary")


def _paths(docs: DataFrame, ngram: int, percent: int) -> DataFrame:
    """(path, dig) of every set; a task writes a digest's paths once."""
    def run(batches):
        branching, met = Branching(percent), set()
        for batch in batches:
            for words in word_chunks(batch.column("text")):
                paths, digs = [], []
                for i in range(len(words)):
                    items = shingle_hashes(words.of(i), ngram)
                    if not len(items) or (d := _digest(items)) in met:
                        continue
                    met.add(d)
                    paths.append(path_digests(items, percent, branching).view(np.int64))
                    digs.append(np.full(len(paths[-1]), d))
                if paths:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(paths)), pa.array(np.concatenate(digs))], ["path", "dig"])
    return docs.select("text").mapInArrow(run, "path long, dig long")


def _shared_paths(rows: DataFrame) -> DataFrame:
    """Distinct (path, dig) of the paths that at least two digests have.

    The partition is sorted by (path, dig) and streams through; of a path only
    the last digest is remembered, however many rows it has.
    """
    def run(batches):
        last, pending = None, False     # last (path, dig); pending: not yet written
        for batch in batches:
            p = batch.column("path").to_numpy()
            d = batch.column("dig").to_numpy()
            if not len(p):
                continue
            if last is not None:
                p, d = np.r_[last[0], p], np.r_[last[1], d]
            new = np.r_[True, (p[1:] != p[:-1]) | (d[1:] != d[:-1])]
            written = last is not None and not pending
            p, d = p[new], d[new]
            same = p[1:] == p[:-1]
            keep = np.r_[False, same] | np.r_[same, False]
            emit = keep.copy()
            if written:
                emit[0] = False
            emit[-1] = keep[-1] and not (written and len(p) == 1)
            last = (p[-1], d[-1])
            pending = not (keep[-1] or (written and len(p) == 1))
            if emit.any():
                yield pa.RecordBatch.from_arrays([pa.array(p[emit]), pa.array(d[emit])], ["path", "dig"])
    return (rows.repartition("path").sortWithinPartitions("path", "dig")
            .mapInArrow(run, "path long, dig long"))


def _contents(docs: DataFrame, wanted: DataFrame, ngram: int) -> DataFrame:
    """(dig, n, items) of the wanted (dig, rep, key): one document's set each. A document is found by
    its id and a hash of its text, as ids may be missing or repeated."""
    rows = docs.join(wanted, docs.doc_id.eqNullSafe(wanted.rep) & (docs.key == wanted.rep_key)) \
        .select("dig", "text").dropDuplicates(["dig"])

    def run(batch):
        digs = batch.column("dig").to_pylist()
        for words in word_chunks(batch.column("text")):
            out = []
            for i in range(len(words)):
                items = shingle_hashes(words.of(i), ngram)
                out.append((digs[words.first + i], len(items), items.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary()))], ["dig", "n", "items"])
    return map_arrow(rows, run, "dig long, n long, items binary")


def _with_smaller(shared: DataFrame, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """``shared`` with n, cells, part (the component of ``labels``, else the set) and below: the set's
    shared paths that are smaller, of its ``_KNOWN`` smallest."""
    own = (shared.groupBy("dig").agg(F.sort_array(F.collect_list("path")).alias("paths"))
           .join(nodes.select("dig", "n", "cells"), "dig")
           .join(labels.withColumnRenamed("node", "dig"), "dig", "left")
           .withColumn("part", F.coalesce("component", "dig"))
           .withColumn("known", F.slice("paths", F.lit(1), F.lit(_KNOWN))))
    return (own.select("dig", "n", "cells", "part", "known", F.posexplode("paths").alias("at", "path"))
            .select("path", "dig", "n", "cells", "part", F.slice("known", F.lit(1), F.col("at")).alias("below")))


def _units(shared: DataFrame, block: int, paths: DataFrame | None = None) -> DataFrame:
    """The rows of each shared path by unit: one unit per path, or per pair of
    blocks where more than ``block`` sets share the path (``paths``: a plain table to count them from)."""
    below = [c for c in ("below",) if c in shared.columns]
    hot = ((shared if paths is None else paths).groupBy("path").count().where(F.col("count") > block)
           .select("path", F.ceil(F.col("count") / block).cast("int").alias("blocks")))
    # at most one hot path in ``block`` rows: the rows with their cells need not be shuffled by path for it
    return (shared.join(F.broadcast(hot), "path", "left")
            .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
            .withColumn("own", F.pmod(F.hash("dig"), F.col("blocks")))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("unit", F.xxhash64("path", F.least("own", "other"), F.greatest("own", "other")))
            .select("unit", (F.col("own") != F.col("other")).alias("mixed"), "own", "dig", "n", "cells", "part", *below))


class _Rows:
    """Rows of whole units as arrays, and the pairs among them that may link."""

    def __init__(self, table: pa.Table, percent: int) -> None:
        cols = {c: table.column(c).to_numpy() for c in ("unit", "own", "dig", "n", "part")}
        self.unit, self.own, self.dig, self.n, self.part = cols.values()
        self.mixed = table.column("mixed").to_numpy()
        self.cells = np.frombuffer(b"".join(table.column("cells").to_pylist()), np.uint8).reshape(-1, _CELLS)
        self.percent = percent
        if "below" in table.column_names:
            below = table.column("below").combine_chunks()
            self.below = below.flatten().to_numpy(zero_copy_only=False)
            self.ends = np.cumsum(below.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
            self.starts = np.r_[0, self.ends[:-1]]

    def first_meeting(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """False for the pairs that are known to have a smaller path in common: they have met there."""
        size = self.ends[i] - self.starts[i]
        pair = np.repeat(np.arange(len(i)), size)
        at = np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size)
        path = self.below[self.starts[i][pair] + at]
        low, high = self.starts[j][pair], self.ends[j][pair]
        end = high
        while (open_ := low < high).any():      # binary search of each path in the other row's list
            middle = np.where(open_, (low + high) // 2, 0)
            less = self.below[middle] < path
            low, high = np.where(open_ & less, middle + 1, low), np.where(open_ & ~less, middle, high)
        met = low < end
        met[met] = self.below[low[met]] == path[met]
        first = np.ones(len(i), bool)
        first[pair[met]] = False
        return first

    def close(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs of different parts (and blocks) within the size and count bounds."""
        t, n = self.percent, self.n
        ok = (self.part[i] != self.part[j]) & (100 * np.minimum(n[i], n[j]) >= t * np.maximum(n[i], n[j]))
        ok &= ~self.mixed[i] | (self.own[i] != self.own[j])
        i, j = i[ok], j[ok]
        kept = []
        for at in range(0, len(i), 1 << 13):
            a, b = i[at:at + (1 << 13)], j[at:at + (1 << 13)]
            apart = np.abs(self.cells[a].astype(np.int16) - self.cells[b]).sum(1)
            kept.append(apart <= (100 - t) * (n[a] + n[b]) // (100 + t))
        ok = np.concatenate(kept) if kept else np.empty(0, bool)
        return i[ok], j[ok]

    def with_pivots(self, salt: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs with one row of each unit, drawn by a hash of unit and set, so that a set
        meets another pivot on each of its paths."""
        start = np.flatnonzero(np.r_[True, self.unit[1:] != self.unit[:-1]])
        size = np.diff(np.r_[start, len(self.unit)])
        draw = mix(mix(self.unit.view(U64) + U64(salt)) ^ self.dig.view(U64))
        pivot = np.repeat(np.lexsort((draw, np.repeat(start, size)))[start], size)
        rest = np.flatnonzero(pivot != np.arange(len(pivot)))
        return self.close(pivot[rest], rest)

    def candidates(self) -> tuple[np.ndarray, np.ndarray]:
        """(rows with a candidate where both sets are short, all other candidates as distinct pairs
        of digests); without the pairs that a smaller path has shown."""
        found, pairs = np.zeros(len(self.unit), bool), [np.empty((0, 2), np.int64)]
        live, k = np.arange(len(self.unit)), 0
        while len(live):
            k += 1
            live = live[live + k < len(self.unit)]
            live = live[self.unit[live] == self.unit[live + k]]
            i, j = self.close(live, live + k)
            short = np.maximum(self.n[i], self.n[j]) <= _SHORT
            new = short & ~(found[i] & found[j])
            if new.any():
                a, b = i[new], j[new]
                first = self.first_meeting(a, b)
                found[a[first]] = found[b[first]] = True
            if not short.all():
                a, b = i[~short], j[~short]
                first = self.first_meeting(a, b)
                a, b = self.dig[a[first]], self.dig[b[first]]
                pairs.append(np.stack([np.minimum(a, b), np.maximum(a, b)], 1))
        return np.flatnonzero(found), np.unique(np.concatenate(pairs), axis=0)


def _whole_units(batches):
    """Tables that hold whole units, of batches sorted by unit."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        unit = table.column("unit").to_numpy()
        done = int(np.searchsorted(unit, unit[-1]))     # the last unit may go on
        held = table.slice(done)
        if done:
            yield table.slice(0, done)
    if held is not None:
        yield held


def _pivot_pairs(shared: DataFrame, percent: int, salt: int, block: int = _BLOCK) -> DataFrame:
    """Distinct candidates (a < b) among the pairs with the pivot of each unit.
    ``shared`` has path, dig, n, cells and part."""
    def run(batches):
        for table in _whole_units(batches):
            rows = _Rows(table, percent)
            i, j = rows.with_pivots(salt)
            a, b = rows.dig[i], rows.dig[j]
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
            if len(pairs):
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])
    return (_units(shared, block).repartition("unit").sortWithinPartitions("unit", "dig")
            .mapInArrow(run, "a long, b long").distinct())


def _suspects(shared: DataFrame, percent: int, block: int = _BLOCK, paths: DataFrame | None = None) -> DataFrame:
    """Candidates of different parts: rows (unit, mixed, own, dig, part) of short sets, and pairs
    (dig, other) of long ones (unit NULL). ``shared`` also has below (:func:`_with_smaller`): sets that
    share many paths meet in one unit, not in all."""
    def run(batches):
        for table in _whole_units(batches):
            rows = _Rows(table, percent)
            at, pairs = rows.candidates()
            if len(at):
                names = ["unit", "mixed", "own", "dig", "part"]
                part = table.select(names).take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c).combine_chunks() for c in names], pa.nulls(len(at), pa.int64())], [*names, "other"])
            if len(pairs):
                none = pa.nulls(len(pairs), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [none, none.cast(pa.bool_()), none.cast(pa.int32()), pa.array(pairs[:, 0]), none, pa.array(pairs[:, 1])],
                    ["unit", "mixed", "own", "dig", "part", "other"])
    return (_units(shared, block, paths).repartition("unit").sortWithinPartitions("unit", "dig")
            .mapInArrow(run, "unit long, mixed boolean, own int, dig long, part long, other long"))


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, as products of the sets' incidence matrix, some columns at a time."""
    n = np.array([len(x) for x in sets])
    universe, at = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), n)
    common = np.zeros((len(sets), len(sets)), np.int64)     # callers multiply it: float32 would round
    order = np.argsort(at, kind="stable")
    at, row = at[order], row[order]
    width = min(1 << 11, len(universe))
    for first in range(0, len(universe), width):
        i, j = np.searchsorted(at, [first, first + width])
        part = np.zeros((len(sets), width), np.float32)
        part[row[i:j], at[i:j] - first] = 1
        common += (part @ part.T).astype(np.int64)
    return common


def _joining_links(suspects: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the parts of each unit, one for every two parts that they join."""
    def run(batches):
        for table in _whole_units(batches):
            unit = table.column("unit").to_numpy()
            own, dig, part, n = (table.column(c).to_numpy() for c in ("own", "dig", "part", "n"))
            mixed = table.column("mixed").to_numpy()
            items = [np.frombuffer(x, U64) for x in table.column("items").to_pylist()]
            start = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
            out = []
            for i, j in zip(start, np.r_[start[1:], len(unit)]):
                size = n[i:j]
                ok = overlaps(items[i:j]) * (100 + percent) >= percent * (size[:, None] + size[None, :])
                ok &= part[i:j, None] != part[None, i:j]
                if mixed[i]:
                    ok &= own[i:j, None] != own[None, i:j]
                parent: dict = {}

                def root(x):
                    while parent.setdefault(x, x) != x:
                        parent[x] = x = parent[parent[x]]
                    return x
                for a, b in np.argwhere(np.triu(ok)).tolist():
                    x, y = root(part[i + a]), root(part[i + b])
                    if x != y:
                        parent[x] = y
                        out.append((min(dig[i + a], dig[i + b]), max(dig[i + a], dig[i + b])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])
    return (suspects.join(sets, "dig").repartition("unit").sortWithinPartitions("unit", "dig")
            .mapInArrow(run, "a long, b long").distinct())


def trie_links(probe: np.ndarray, sets: list[np.ndarray], percent: int) -> list[int]:
    """Indexes of ``sets`` (sorted arrays) that link with ``probe``: one traversal
    of their path-compressed prefix tree."""
    # big-endian bytes sort like the element sequences
    order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
    rows = [sets[i] for i in order]
    n, out = len(probe), []
    stack = [(0, len(rows), 0, 0)]        # rows lo:hi share `depth` elements, `common` of them in the probe
    while stack:
        lo, hi, depth, common = stack.pop()
        a, b = rows[lo], rows[hi - 1]
        width = min(len(a), len(b))
        differ = np.flatnonzero(a[depth:width] != b[depth:width])
        end = depth + int(differ[0]) if len(differ) else width
        edge = a[depth:end]
        if len(edge):
            at = np.searchsorted(probe, edge)
            common += int((probe[np.minimum(at, n - 1)] == edge).sum())
            left = n - int(np.searchsorted(probe, edge[-1], "right"))
        else:
            left = n if end == 0 else n - int(np.searchsorted(probe, a[end - 1], "right"))
        sizes = [len(r) for r in rows[lo:hi]]
        best = common + min(left, max(sizes) - end)
        if best * (100 + percent) < percent * (n + min(sizes)):
            continue
        i = lo
        while i < hi and len(rows[i]) == end:     # a set that ends here
            if common * (100 + percent) >= percent * (n + end):
                out.append(order[i])
            i += 1
        while i < hi:
            j = i + 1
            while j < hi and rows[j][end] == rows[i][end]:
                j += 1
            stack.append((i, j, end, common))
            i = j
    return out


def _verify(pairs: DataFrame, sets: DataFrame, percent: int, fan: int = _FAN) -> DataFrame:
    """The pairs that link: a prefix tree over each probe's candidates."""
    many = (pairs.groupBy("a").count().where(F.col("count") > fan)
            .select("a", F.ceil(F.col("count") / fan).cast("int").alias("parts")))
    pairs = (pairs.join(many, "a", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
             .withColumn("part", F.pmod(F.hash("b"), F.col("parts"))))
    probes = (pairs.select("a", "part").distinct()
              .join(sets.select(F.col("dig").alias("a"), "items"), "a")
              .select("a", "part", F.lit(None).cast("long").alias("b"), "items"))
    others = (pairs.select("a", "part", "b")
              .join(sets.select(F.col("dig").alias("b"), "items"), "b")
              .select("a", "part", "b", "items"))

    def run(table: pa.Table) -> pa.Table:
        b = table.column("b").to_pylist()
        items = [np.frombuffer(x, U64) for x in table.column("items").to_pylist()]
        at = b.index(None)
        probe = items[at]
        keep = [i for i in range(len(b)) if i != at]
        hits = [b[keep[i]] for i in trie_links(probe, [items[i] for i in keep], percent)]
        a = table.column("a")[0].as_py()
        return pa.table({"a": pa.array([a] * len(hits), pa.int64()), "b": pa.array(hits, pa.int64())})
    return probes.union(others).groupBy("a", "part").applyInArrow(run, "a long, b long")


def _link_counts(members: DataFrame, percent: int, block: int = _FAN) -> DataFrame:
    """(dig, partners): documents in other sets that link with a set.

    ``members`` has component, dig, copies, n and items. The sets of a component
    are dealt into blocks; a task multiplies the incidence matrices of two blocks.
    """
    sizes = members.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    rows = (members.join(sizes, "component")
            .withColumn("own", F.pmod(F.hash("dig"), F.col("blocks")))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other"))
            .select("component", "lo", "hi", "own", "dig", "copies", "n", "items"))

    def run(table: pa.Table) -> pa.Table:
        own, dig, copies, n = (table.column(c).to_numpy() for c in ("own", "dig", "copies", "n"))
        sets = [np.frombuffer(x, U64) for x in table.column("items").to_pylist()]
        lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
        common = overlaps(sets)
        linked = common * (100 + percent) >= percent * (n[:, None] + n[None, :])
        np.fill_diagonal(linked, False)
        if lo != hi:
            linked &= own[:, None] != own[None, :]
        return pa.table({"dig": pa.array(dig), "partners": pa.array((linked * copies[None, :]).sum(1).astype(np.int64))})
    return (rows.groupBy("component", "lo", "hi").applyInArrow(run, "dig long, partners long")
            .groupBy("dig").agg(F.sum("partners").alias("partners")))


def jaccard_join(docs: DataFrame, ngram: int = NGRAM, percent: int = PERCENT) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, n_links.

    ``docs`` needs doc_id and text; other columns are ignored. Two documents
    link when ``100 * |A & B| >= percent * |A | B|``. component_id is the smallest
    doc_id reachable by links, itself included; n_links counts the documents
    linked directly, copies included.

    NULL, empty and blank texts have the empty set: 0 shingles, no link, their own
    id. Fewer words than ``ngram`` make one shingle. Repeated rows are separate
    documents that link. A NULL doc_id links like any other but is never
    the smallest id; a component without any id has component_id NULL. Sets are
    compared by 64-bit shingle hashes. An empty table gives an empty result.
    """
    return _grouped(docs, ngram, percent).drop("dig", "group")


def _grouped(docs: DataFrame, ngram: int, percent: int) -> DataFrame:
    """The rows of :func:`jaccard_join` with dig (the set's digest, NULL if empty) and group
    (the component's, any digest of it)."""
    docs = with_defaults(docs, "doc_id", "text").withColumn("key", F.xxhash64("text"))
    sets = materialize(_sets(docs, ngram), "shingle-sets")
    nodes = materialize(
        sets.where("dig is not null").groupBy("dig").agg(
            F.min("doc_id").alias("rep"), F.coalesce(F.min_by("key", "doc_id"), F.min("key")).alias("rep_key"),
            F.count(F.lit(1)).alias("copies"), F.max("n").alias("n"), F.max("cells").alias("cells")), "jaccard-nodes")
    shared = materialize(_shared_paths(_paths(docs, ngram, percent)), "shared-paths")
    rows = shared.join(nodes.select("dig", "n", "cells"), "dig")

    def contents_of(digs: DataFrame) -> DataFrame:
        wanted = nodes.join(digs.distinct(), "dig", "left_semi").select("dig", "rep", "rep_key")
        return materialize(_contents(docs, wanted, ngram), "jaccard-sets")

    def verified(pairs: DataFrame) -> DataFrame:
        contents = contents_of(pairs.select(F.col("a").alias("dig")).union(pairs.select("b")))
        return materialize(_verify(pairs, contents, percent), "jaccard-links")

    links = verified(materialize(_pivot_pairs(rows.withColumn("part", F.col("dig")), percent, 1), "jaccard-pairs"))
    labels = components(links)
    suspects = materialize(_suspects(_with_smaller(shared, nodes, labels), percent, paths=shared), "jaccard-suspects")
    short = suspects.where("other is null").drop("other")
    long = suspects.where("other is not null").select(F.col("dig").alias("a"), F.col("other").alias("b")).distinct()
    links = (links.union(materialize(_joining_links(short, contents_of(short.select("dig")), percent), "jaccard-links"))
             .union(verified(materialize(long, "jaccard-pairs"))))
    labels = components(links)
    members = labels.withColumnRenamed("node", "dig").join(nodes, "dig")
    contents = _contents(docs, members.select("dig", "rep", "rep_key"), ngram).select("dig", "items")
    degree = _link_counts(members.select("component", "dig", "copies", "n").join(contents, "dig"), percent)
    lowest = members.groupBy("component").agg(F.min("rep").alias("lowest"))
    linked = members.select("dig", "component").join(lowest, "component").join(degree, "dig")
    known = nodes.join(linked, "dig", "left").select(
        "dig", F.coalesce("component", "dig").alias("group"), F.coalesce("lowest", "rep").alias("component_id"),
        (F.col("copies") - 1 + F.coalesce("partners", F.lit(0))).alias("n_links"))
    filled = (sets.where("dig is not null").select("doc_id", "n", "dig").join(known, "dig")
              .select("doc_id", F.col("n").alias("n_shingles"), "component_id", "n_links", "dig", "group"))
    bare = sets.where("dig is null").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"),
        F.lit(0).cast("long").alias("n_links"), "dig", F.col("dig").alias("group"))
    return filled.union(bare)


def one_of_each(docs: DataFrame, ngram: int = NGRAM, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` with only the smallest id of every group of linked documents.

    A row goes by its own text: where an id is repeated with different texts, each is
    judged with its own group. Of rows that agree in id and set one stays, of a group without any
    id one; a row without an id goes with a group that has one. Rows without words have no
    group: they stay, equal ones (id and text, id not NULL) once.
    """
    plain = [f"`{c}`" for c in docs.columns]
    out = materialize(_grouped(docs, ngram, percent), "jaccard-groups")
    known = out.where("doc_id is not null")
    gone = known.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    repeated = materialize(known.groupBy("doc_id").count().where("count > 1").select("doc_id"), "jaccard-repeated")
    single = docs.where("doc_id is not null").join(repeated, "doc_id", "left_anti").join(gone, "doc_id", "left_anti").select(*plain)
    odd = out.where("doc_id is null").select(F.lit(1)).unionAll(repeated.select(F.lit(1)))
    if odd.isEmpty():
        return single
    rows = docs.where("doc_id is null").unionAll(docs.where("doc_id is not null").join(repeated, "doc_id", "left_semi").select(*plain))
    rows = _with_digests(rows, ngram)
    name = [c for c in rows.columns if c not in docs.columns][0]
    nameless = out.where("dig is not null and component_id is null").groupBy("group").agg(F.min("dig").alias("kept_dig"))
    kept = (out.where("dig is not null and doc_id = component_id").select(F.col("doc_id").alias("kept_id"), F.col("dig").alias("kept_dig"))
            .unionAll(nameless.select(F.lit(None).cast("long"), "kept_dig")).distinct())
    worded = (rows.where(F.col(name).isNotNull()).dropDuplicates(["doc_id", name])
              .join(kept, F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col(name) == F.col("kept_dig")), "left_semi").select(*plain))
    bare = rows.where(F.col(name).isNull())
    return (single.unionAll(worded).unionAll(bare.where("doc_id is null").select(*plain))
            .unionAll(bare.where("doc_id is not null").dropDuplicates(["doc_id", "text"]).select(*plain)))


def _with_digests(docs: DataFrame, ngram: int) -> DataFrame:
    """``docs`` and, in a column of a new name, each row's set digest (NULL without words)."""
    name = "dig"
    while name in docs.columns:
        name += "_"
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            digs = []
            for words in word_chunks(batch.column(at)):
                for i in range(len(words)):
                    items = shingle_hashes(words.of(i), ngram)
                    digs.append(_digest(items) if len(items) else None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digs, pa.int64())], [*batch.schema.names, name])
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))
