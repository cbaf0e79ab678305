"""Exact top-k search over binary codes by incremental multi-index hashing.

Codes are cut into m segments of at most log2(n) bits (so that a segment has no more values than there
are codes to meet: wider ones would be probed mostly in vain), and every segment of every code is
indexed. The search radius grows segment by segment: step (r, s) probes all values at
Hamming distance r from an open query's own value in segment s. After it, a code that
has not been met differs by r + 1 bits or more in segments 0 .. s and by r or more in the
others, so all codes up to distance m * r + s are verified; a query closes when its k-th
best distance is within that. Codes beyond the k-th best distance so far are dropped where they
are met. Equal codes are searched as one.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaar.llm.common import materialize

K = 10
EVERY = 50              # ids divisible by this are the queries


def binary_code(vector: Column, bits: int) -> Column:
    """Sign bits of a vector as ``array<bigint>`` of 64-bit words (missing elements count as 0 bits)."""
    words = []
    for first in range(0, bits, 64):
        word = F.lit(0).cast("long")
        for i in range(first, min(bits, first + 64)):
            bit = 1 << (i - first)
            bit = bit - (1 << 64) if bit >= 1 << 63 else bit
            word = word.bitwiseOR(F.when(F.get(vector, F.lit(i)) > 0, F.lit(bit)).otherwise(F.lit(0)).cast("long"))
        words.append(word)
    return F.array(*words)


def segments(bits: int, rows: int) -> list[tuple[int, int, int]]:
    """(word, shift, width) of the segments for an index of ``rows`` codes."""
    out, size = [], max(2, rows).bit_length() - 1            # floor(log2(rows)), 1 at least
    for word in range(-(-bits // 64)):
        here = min(64, bits - 64 * word)
        m = min(here, max(1, -(-here // size), -(-here // 20)))      # 20 bits at most
        shift = 0
        for i in range(m):
            width = here * (i + 1) // m - here * i // m
            out.append((word, shift, width))
            shift += width
    return out


def _value(code: Column, segment: tuple[int, int, int]) -> Column:
    word, shift, width = segment
    return F.call_function("shiftrightunsigned", code[word], F.lit(shift)).bitwiseAND(F.lit((1 << width) - 1))


def _steps(parts: list[tuple[int, int, int]]) -> list[tuple[int, list[int]]]:
    """(radius, segments): radius 0 and 1 for all segments at once, then one segment at a time."""
    widest = max(p[2] for p in parts)
    out = [(r, list(range(len(parts)))) for r in (0, 1)]
    return out + [(r, [i]) for r in range(2, widest + 1) for i in range(len(parts))]


def _probes(parts: list[tuple[int, int, int]], radius: int, at: list[int]) -> Column:
    """All (segment, difference of ``radius`` bits) of some segments, as a constant array."""
    texts = [f"{i}:{sum(1 << b for b in c)}" for i in at for c in combinations(range(parts[i][2]), radius)]
    return F.transform(F.split(F.lit(",".join(texts)), ","), lambda t: F.struct(
        F.split(t, ":")[0].cast("int").alias("seg"), F.split(t, ":")[1].cast("long").alias("mask")))


def _first_hit(a: Column, b: Column, seg: Column, parts: list[tuple[int, int, int]], radius: int) -> Column:
    """True where segment ``seg`` is the first one at distance ``radius`` and none is closer: each
    code is then verified once per query, in one segment of one round."""
    ok = F.lit(True)
    for i, part in enumerate(parts):
        d = F.bit_count(_value(a, part).bitwiseXOR(_value(b, part)))
        ok = ok & F.when(seg > i, d > radius).otherwise(d >= radius)
    return ok


def _distance(a: Column, b: Column, bits: int) -> Column:
    return sum((F.bit_count(a[w].bitwiseXOR(b[w])) for w in range(-(-bits // 64))), F.lit(0)).cast("int")


def _met(open_: DataFrame, index: DataFrame, parts: list[tuple[int, int, int]], radius: int, at: list[int], bits: int) -> DataFrame:
    """(q, distance, ids) of the codes that step (``radius``, ``at``) shows for the first time, up to a
    query's ``reach``: the join itself drops the others, so they are neither sorted nor shuffled."""
    own = F.array(*[_value(F.col("q"), p) for p in parts])
    probes = (open_.select("q", "reach", own.alias("own"), F.inline(_probes(parts, radius, at)))
              .select("q", "reach", "seg", F.get("own", F.col("seg")).bitwiseXOR(F.col("mask")).alias("value")))
    distance = _distance(F.col("q"), F.col("code"), bits)
    # the optimiser does not see how many rows the probes become: keep it from broadcasting them
    return (probes.hint("merge").join(index, ["seg", "value"])
            .where((distance <= F.col("reach")) & _first_hit(F.col("q"), F.col("code"), F.col("seg"), parts, radius))
            .select("q", distance.alias("distance"), "ids"))


def top_k(rows: DataFrame, queries: DataFrame, bits: int, k: int = K) -> DataFrame:
    """(query_id, rank, neighbor_id, distance) of tables (id, code): the k rows of the smallest
    Hamming distance to each query, ties by id.

    The index holds distinct codes; a code keeps its k smallest ids, more can never
    be among the first k. Ids are unique, NULL ids and codes are left out.
    """
    rows = rows.where("id is not null and code is not null")
    by_id = Window.partitionBy("code").orderBy("id")
    codes = materialize(
        rows.withColumn("r", F.row_number().over(by_id)).where(F.col("r") <= k)
        .groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "hamming-codes")
    parts = segments(bits, codes.count())
    m = len(parts)
    entries = F.array(*[F.struct(F.lit(i).alias("seg"), _value(F.col("code"), p).alias("value")) for i, p in enumerate(parts)])
    index = materialize(codes.select("code", "ids", F.inline(entries)), "hamming-index")
    queries = queries.where("id is not null and code is not null")
    # reach: a code beyond this distance is not among the k
    open_ = materialize(queries.select(F.col("code").alias("q"), F.lit(bits).alias("reach")).distinct(), "hamming-open")
    best = None
    for radius, at in _steps(parts):
        if not any(radius <= parts[i][2] for i in at):
            continue
        new = _met(open_, index, parts, radius, at, bits).select("q", "distance", F.explode("ids").alias("id"))
        every = new if best is None else new.union(best.select("q", "distance", "id"))
        order = Window.partitionBy("q").orderBy("distance", "id")
        best = materialize(every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "hamming-best")
        proven = m * radius + at[-1]
        last = best.where(F.col("rank") == k).select("q", F.col("distance").alias("last"))
        open_ = materialize(open_.join(last, "q", "left").where(F.col("last").isNull() | (F.col("last") > proven))
                            .select("q", F.coalesce("last", "reach").alias("reach")), "hamming-open")
        if not open_.limit(1).count():
            break
    return (queries.join(best, queries.code == best.q)
            .select(queries.id.alias("query_id"), F.col("rank").cast("int").alias("rank"),
                    best.id.alias("neighbor_id"), "distance"))


def embedding_top_k(embeddings: DataFrame, k: int = K, every: int = EVERY, id_col: str = "vec_id") -> DataFrame:
    """The top k of every row whose id is divisible by ``every``, against all rows (itself included).

    Codes are the sign bits of ``embedding`` (1 where positive). Rows with a NULL id or a NULL or
    empty embedding are neither found nor queries. Equal codes tie; ties go by id. Rows with
    the same id and code are one. Other columns are ignored; fewer than k rows give shorter lists.
    """
    rows = embeddings.select(F.col(id_col).alias("id"), "embedding").where("size(embedding) > 0 and id is not null")
    bits = rows.agg(F.max(F.size("embedding"))).first()[0]
    if bits is None:
        return embeddings.sparkSession.createDataFrame(
            [], "query_id long, rank int, neighbor_id long, distance int")
    rows = rows.select(F.col("id").cast("long").alias("id"), binary_code(F.col("embedding"), bits).alias("code")).distinct()
    return top_k(rows, rows.where(F.col("id") % every == 0), bits, k)
