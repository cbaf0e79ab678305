"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text's paragraphs (lines, cut further at sentence ends) are hashed; the sketch adds
each distinct digest to three cells. A cell is the XOR of its digests, and a
digest carries 24 check bits, which tell a cell that holds one digest from any other. Two
versions' cells subtract (XOR) to the sketch of their differing digests, and peeling
recovers these. Where the small sketch cannot hold the difference, the pair is
sketched again: digests are dealt by hash to as many sub-sketches as the sizes call
for, and a part that still fails is tried with twice the cells, again and again. Only
DataFrame expressions are used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# a line end, or a sentence end: a stop and a space, or a full-width stop, which no space follows. A cut
# depends on the text around it alone, so it stays where it is when other parts change
_PARAGRAPH = r"\n+|(?<=[.!?\u2026\u061f\u06d4\u0964\u0965]) |(?<=[\u3002\uff01\uff1f\uff61])"
_CHECK = 0xFFFFFF       # check bits of a digest
_WIDTH = 8              # cells per hash function of a sketch, a power of two
_LOAD = 4               # digests of the larger version per sub-sketch, at most
_ROUNDS = 8             # peeling rounds; a sketch that needs more counts as failed
_RETRIES = 4            # doublings of a failed part before its sets are compared directly
_BUCKET = 2000          # documents per bucket of the order, about
_MOST_BUCKETS = 10_000


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _shift(k: Column, by: int | Column) -> Column:
    return F.call_function("shiftrightunsigned", k, F.lit(by) if isinstance(by, int) else by)


def _checked(k: Column) -> Column:
    """The check bits of a digest's upper 40 bits."""
    return F.xxhash64(_shift(k, 24)).bitwiseAND(F.lit(_CHECK))


def digests(text: Column) -> Column:
    """Distinct digests of a text's paragraphs (40 hash bits, 24 check bits); none for an empty text."""
    def digest(p: Column) -> Column:
        return _let(F.xxhash64(p), lambda d: d.bitwiseAND(F.lit(~_CHECK)).bitwiseOR(_checked(d)))
    return F.array_distinct(F.transform(F.filter(F.split(text, _PARAGRAPH), lambda p: p != ""), digest))


def _items(keys: Column, width: int, seed: int) -> Column:
    """Each digest with its cell in each third of a sketch."""
    def item(k: Column) -> Column:
        cell = lambda h, by: _shift(h, by).bitwiseAND(F.lit(width - 1)).cast("int")
        return _let(F.xxhash64(k, F.lit(seed)), lambda h: F.struct(
            k.alias("k"), cell(h, 0).alias("a"), cell(h, 20).alias("b"), cell(h, 40).alias("c")))
    return F.transform(keys, item)


def _added(cells: Column, items: Column, field: str) -> Column:
    """A third of a sketch with the items' digests added (or taken out: XOR is both)."""
    return F.transform(cells, lambda cell, j: F.aggregate(
        items, cell, lambda acc, x: F.when(x[field] == j, acc.bitwiseXOR(x["k"])).otherwise(acc)))


def _thirds(a: Column, b: Column, c: Column) -> Column:
    return F.struct(a.alias("a"), b.alias("b"), c.alias("c"))


def sketch(keys: Column, width: int = _WIDTH, seed: int = 1) -> Column:
    """The cells, by hash function: struct<a, b, c: array<bigint>>."""
    zero = F.array(*[F.lit(0).cast("long")] * width)
    return _let(_items(keys, width, seed), lambda items: _thirds(*[_added(zero, items, f) for f in "abc"]))


def subtract(x: Column, y: Column) -> Column:
    return _thirds(*[F.zip_with(x[f], y[f], lambda p, q: p.bitwiseXOR(q)) for f in "abc"])


def peel(cells: Column, width: int = _WIDTH, seed: int = 1) -> Column:
    """Number of digests in a difference sketch, or NULL when it cannot be decoded.

    A round takes all cells with a single digest and removes these digests from all cells at once.
    """
    def single(cells: Column) -> Column:
        alone = F.filter(F.concat(cells["a"], cells["b"], cells["c"]),
                         lambda v: (v != 0) & (v.bitwiseAND(F.lit(_CHECK)) == _checked(v)))
        return _items(F.array_distinct(alone), width, seed)

    def state(cells: Column, n: Column, more: bool) -> Column:
        return F.struct(cells.alias("cells"), n.cast("int").alias("n"), F.lit(more).alias("more"))

    def step(acc: Column, _: Column) -> Column:
        cells = acc["cells"]
        return F.when(acc["more"], _let(single(cells), lambda found: F.when(
            F.size(found) > 0, state(_thirds(*[_added(cells[f], found, f) for f in "abc"]), acc["n"] + F.size(found), True))
            .otherwise(state(cells, acc["n"], False)))).otherwise(acc)
    done = F.aggregate(F.sequence(F.lit(1), F.lit(_ROUNDS)), state(cells, F.lit(0), True), step)
    return _let(done, lambda d: F.when(F.forall(d["cells"]["a"], lambda v: v == 0), d["n"]))


def _parts(keys: str, high: str, low_bits: str, low: str) -> Column:
    """Digests dealt to high * low parts by their hash bits, in two levels
    (so n digests take n * (high + low) steps)."""
    bits = lambda k, by, size, p: _shift(k, by).bitwiseAND(F.col(size) - 1) == p
    groups = F.transform(F.sequence(F.lit(0).cast("long"), F.col(high) - 1), lambda p: F.filter(
        keys, lambda k: bits(k, F.col(low_bits), high, p)))
    return F.flatten(F.transform(groups, lambda group: F.transform(
        F.sequence(F.lit(0).cast("long"), F.col(low) - 1), lambda p: F.filter(group, lambda k: bits(k, 24, low, p)))))


def _attempt(width: int, seed: int):
    """Tries the parts that are not decoded yet with sketches of ``width``."""
    def tried(p: Column) -> Column:
        return F.when(p["n"].isNotNull(), p).otherwise(F.struct(
            p["x"].alias("x"), p["y"].alias("y"),
            peel(subtract(sketch(p["x"], width, seed), sketch(p["y"], width, seed)), width, seed).alias("n")))
    return tried


def difference(rows: DataFrame, a: str, b: str, cells_a: str, cells_b: str, out: str) -> DataFrame:
    """Adds ``out``: the number of digests in which the arrays ``a`` and ``b`` differ.

    The small sketches ``cells_a`` and ``cells_b`` are tried first, then parts, then larger parts.
    """
    keep = list(rows.columns)
    larger = F.greatest(F.size(a), F.size(b), F.lit(1))
    bits = F.least(F.greatest(F.ceil(F.log2(larger / F.lit(float(_LOAD)))), F.lit(0)), F.lit(24)).cast("int")
    rows = rows.select("*", peel(subtract(F.col(cells_a), F.col(cells_b))).alias("_first"), bits.alias("_bits"))
    power = lambda b: F.call_function("shiftleft", F.lit(1).cast("long"), b)
    half = F.floor(F.col("_bits") / 2).cast("int")
    rows = rows.select("*", power(half).alias("_high"), (F.lit(24) + F.col("_bits") - half).alias("_low_bits"),
                       power(F.col("_bits") - half).alias("_low"))
    rows = rows.withColumn("_parts", F.when(F.col("_first").isNull(), F.zip_with(
        _parts(a, "_high", "_low_bits", "_low"), _parts(b, "_high", "_low_bits", "_low"),
        lambda x, y: F.struct(x.alias("x"), y.alias("y"), F.lit(None).cast("int").alias("n")))))
    for attempt in range(_RETRIES):
        rows = rows.withColumn("_parts", F.transform("_parts", _attempt(_WIDTH << attempt, 2 + attempt)))
    total = F.aggregate("_parts", F.lit(0), lambda acc, p: acc + F.coalesce(
        p["n"], F.size(F.array_except(p["x"], p["y"])) + F.size(F.array_except(p["y"], p["x"]))))
    return rows.withColumn(out, F.coalesce("_first", total)).select(*keep, out)


def likeness(n_a: Column, n_b: Column, differ: Column) -> Column:
    """Jaccard similarity of two sets from their sizes and the size of their difference; 1 for two empty ones."""
    return F.when(n_a + n_b == 0, 1.0).otherwise((n_a + n_b - differ) / (n_a + n_b + differ))


def serialised(n: Column, cells: Column) -> Column:
    """The number of paragraphs and the cells, in hexadecimal."""
    return F.concat(F.hex(n), F.lit(":"), F.array_join(
        F.transform(F.concat(cells["a"], cells["b"], cells["c"]), lambda v: F.hex(v)), "."))


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, next_text) by descending doc_id; after the last comes the first.

    Rows without an id come last; equal ids are ordered by a hash of their text. The ids are
    cut into buckets at actual ids (approximate quantiles); each bucket is one window
    partition and also gets the first row of the bucket below, whose text its
    last row needs.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows, highest = docs.agg(F.count(F.lit(1)), F.max("doc_id")).first()
    buckets = min(_MOST_BUCKETS, max(1, rows // _BUCKET))
    cuts = []
    if buckets > 1 and highest is not None:
        shares = [i / buckets for i in range(1, buckets)]
        cuts = sorted(set(docs.agg(F.percentile_approx("doc_id", shares, 10 * buckets)).first()[0]))
    if cuts:
        # two levels: count whole groups of cuts below the id, then the cuts inside the next group
        size = math.isqrt(len(cuts) - 1) + 1
        groups = [cuts[i:i + size] for i in range(0, len(cuts), size)]
        below = lambda values: F.size(F.filter(values, lambda c: c < F.col("doc_id")))
        longs = lambda values: F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")
        fine = F.transform(F.split(F.lit(";".join(",".join(map(str, g)) for g in groups)), ";"),
                           lambda g: F.split(g, ",").cast("array<bigint>"))
        group = below(longs([g[-1] for g in groups]))
        docs = docs.withColumn("group", group)
        inner = F.coalesce(F.get(fine, F.col("group")), F.array().cast("array<bigint>"))
        bucket = F.when(F.col("doc_id").isNull(), 0).otherwise(F.least(F.col("group") * size + below(inner), F.lit(len(cuts))))
        is_cut = F.array_contains(F.coalesce(F.get(fine, F.col("group")), F.array().cast("array<bigint>")), F.col("doc_id"))
        docs = docs.withColumn("bucket", bucket).withColumn("is_cut", F.coalesce(is_cut, F.lit(False)))
    else:
        docs = docs.withColumn("bucket", F.lit(0)).withColumn("is_cut", F.lit(False))
    place = lambda b, kind: F.struct(b.cast("int").alias("bucket"), F.lit(kind).alias("kind"))
    places = F.concat(
        F.array(place(F.col("bucket"), 0)),
        F.when(F.col("is_cut"), F.array(place(F.col("bucket") + 1, 1))).otherwise(F.array().cast("array<struct<bucket:int,kind:int>>")),
        F.when(F.col("doc_id").eqNullSafe(F.lit(highest).cast("long")), F.array(place(F.lit(0), 2)))
        .otherwise(F.array().cast("array<struct<bucket:int,kind:int>>")))
    dealt = docs.select("doc_id", "text", F.inline(places)).withColumn("tie", F.xxhash64("text"))
    order = Window.partitionBy("bucket").orderBy("kind", F.desc_nulls_last("doc_id"), "tie")
    return (dealt.withColumn("next_text", F.lead("text").over(order))
            .where("kind = 0").select("doc_id", "text", "next_text"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, differ_edited, differ_next.

    The edited text has the last floor(n_chars / 3) code points replaced by the first as many
    of the next document (descending doc_id; after the last, the first). A fingerprint is the
    number of distinct paragraphs and the small sketch's cells; equal texts have equal
    ones. The likenesses are Jaccard similarities of the paragraph sets, computed from the
    digests that peeling recovers (differ_*); two texts without paragraphs have 1.

    NULL texts count as empty. Repeated rows are documents that follow each other; a single
    document is its own next. Other columns are ignored; an empty table gives no rows.
    """
    rows = with_next(docs)
    n = F.char_length("text")
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "text", "next_text",
                       F.concat(F.expr("left(text, char_length(text) - cast(floor(char_length(text) / 3) as int))"),
                                F.expr("left(next_text, cast(floor(char_length(text) / 3) as int))")).alias("edited"))
    rows = rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                       digests(F.col("text")).alias("own"), digests(F.col("edited")).alias("ed"),
                       digests(F.col("next_text")).alias("nx"))
    rows = rows.select("*", sketch(F.col("own")).alias("own_cells"), sketch(F.col("ed")).alias("ed_cells"),
                       sketch(F.col("nx")).alias("nx_cells"))
    rows = difference(rows, "own", "ed", "own_cells", "ed_cells", "differ_edited")
    rows = difference(rows, "own", "nx", "own_cells", "nx_cells", "differ_next")
    own, ed, nx = (F.size(c) for c in ("own", "ed", "nx"))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", serialised(own, F.col("own_cells")).alias("fingerprint"),
        serialised(ed, F.col("ed_cells")).alias("edited_fingerprint"),
        likeness(own, ed, F.col("differ_edited")).alias("near_edited"),
        likeness(own, nx, F.col("differ_next")).alias("near_next"),
        F.col("differ_edited").cast("long").alias("differ_edited"), F.col("differ_next").cast("long").alias("differ_next"))
