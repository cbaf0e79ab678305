"""Exact quantiles by distributed radix selection.

A value becomes an integer of the same order. One aggregation counts the leading bits
per group; running counts tell in which bucket a wanted rank lies. Only that bucket's
rows are counted by their next bits, and at last by value. What is shuffled are
(group, bits, count) rows, never all values; a task holds the buckets of its groups
at most, so a group of any size is selected from in bounded memory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaar.operators.joins import lookup_join
from bazaar.sources.scratch import materialize

#: Low bits left out by the rounds before the last: buckets of a 256th of a factor of two first, of 2^-30 then.
SHIFTS = (32, 10)

_STEPS = 2.0 ** 40      # of a key for a factor of two
_LOWEST = 1075.0        # below the binary logarithm of every double but 0, negated


def order_key(value: Column) -> Column:
    """A BIGINT that never falls when the double rises: the binary logarithm of the absolute value
    as a fixed-point number of 40 fractional bits, with the value's sign; 0 for 0. The logarithm is
    semi-monotonic, so near values may share a key but never change places."""
    log = F.least(F.log2(F.abs(value)), F.lit(1024.0))
    size = ((log + _LOWEST) * _STEPS).cast("long")
    return F.when(value > 0, size).when(value < 0, -size).otherwise(F.lit(0).cast("long"))


def _present(keys: list[str], value: Column) -> Column:
    cond = value.isNotNull() & ~F.isnan(value)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def _rank_places(n: Column, probs: list[float]) -> Column:
    """Wanted ranks of a group of ``n`` values: for every prob the 1-based rank below
    h = (n - 1) p and the one above it, and how far h lies between them."""
    wanted = []
    for i, p in enumerate(probs):
        h = (n - 1) * F.lit(float(p))
        low = F.floor(h).cast("long") + 1
        for side, rank in ((0, low), (1, F.least(low + 1, n))):
            wanted.append(F.struct(F.lit(i).alias("prob"), F.lit(side).alias("side"), rank.alias("rank"),
                                   (h - F.floor(h)).alias("share"), n.alias("n")))
    return F.array(*wanted)


def _hits(counts: DataFrame, within: list[str], wants: Column) -> DataFrame:
    """The buckets that hold wanted ranks: ``counts`` (within, _b, _c, ...) and ``wants`` with their
    ranks counted from the bucket's start."""
    running = F.sum("_c").over(Window.partitionBy(*within).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0))
    run = counts.withColumn("_run", running).withColumn("_w", F.explode(wants))
    before = F.col("_run") - F.col("_c")
    return run.where((F.col("_w.rank") > before) & (F.col("_w.rank") <= F.col("_run"))) \
        .withColumn("_w", F.col("_w").withField("rank", F.col("_w.rank") - before))


def radix_quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float],
                    names: list[str] | None = None, written: bool = False) -> DataFrame:
    """Exact quantiles per group with linear interpolation between order statistics
    (h = (n - 1) * p), the numpy/pandas default: keys, n and ``names`` (default q0, q1, ...).

    Rows with a NULL key or a missing value are ignored, like a pandas group-by. The keys and the value
    are written once and read three times, so that what ``df`` is made from (joins) runs
    once; ``written=True`` says that ``df`` already reads a written table. The buckets wanted by a
    round, one row per group and wanted rank at most, are written, and broadcast when their measured
    size allows it.
    """
    names = names or [f"q{i}" for i in range(len(probs))]
    group = [f"_k{i}" for i in range(len(keys))] or ["_g"]
    named = [F.col(k).alias(g) for k, g in zip(keys, group)] if keys else [F.lit(0).alias("_g")]
    v = F.col(value).cast("double")
    rows = df.where(_present(keys, v)).select(*named, v.alias("_v"))
    rows = (rows if written else materialize(rows, "radix-rows", codec="zstd")).withColumn("_k", order_key(F.col("_v")))

    counts = rows.groupBy(*group, F.shiftright("_k", SHIFTS[0]).alias("_b")).agg(F.count(F.lit(1)).alias("_c"))
    counts = counts.withColumn("_n", F.sum("_c").over(Window.partitionBy(*group)))
    hits = _hits(counts, group, _rank_places(F.col("_n"), probs))
    for above, shift in zip(SHIFTS, [*SHIFTS[1:], None]):
        wanted = materialize(hits.groupBy(*group, F.col("_b").alias("_p")).agg(F.collect_list("_w").alias("_ws")), "radix")
        inside = lookup_join(rows.withColumn("_p", F.shiftright("_k", above)), wanted.select(*group, "_p"),
                             [*group, "_p"], "inner", written=True)
        bucket = F.col("_v") if shift is None else F.shiftright("_k", shift)
        counts = inside.groupBy(*group, "_p", bucket.alias("_b")).agg(F.count(F.lit(1)).alias("_c"))
        hits = _hits(counts.join(wanted, [*group, "_p"]), [*group, "_p"], F.col("_ws"))

    aggs = [F.max("_w.n").alias("n")]       # the last buckets are values
    for i in range(len(probs)):
        this = F.col("_w.prob") == i
        aggs += [F.max(F.when(this & (F.col("_w.side") == 0), F.col("_b"))).alias(f"_a{i}"),
                 F.max(F.when(this & (F.col("_w.side") == 1), F.col("_b"))).alias(f"_b{i}"),
                 F.max(F.when(this, F.col("_w.share"))).alias(f"_f{i}")]
    between = [F.when(F.col(f"_a{i}") == F.col(f"_b{i}"), F.col(f"_a{i}"))
               .otherwise(F.col(f"_a{i}") + (F.col(f"_b{i}") - F.col(f"_a{i}")) * F.col(f"_f{i}")).alias(name)
               for i, name in enumerate(names)]
    return hits.groupBy(*group).agg(*aggs).select(
        *[F.col(g).alias(k) for g, k in zip(group, keys)], F.col("n").cast("long").alias("n"), *between)
