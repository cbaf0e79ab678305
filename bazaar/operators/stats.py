"""Distribution statistics: exact quantiles, histograms, box summaries,
pairwise correlation, linear trend forecast and a reproducible sample.

Scale notes
-----------
* ``exact_quantiles`` never gathers or shuffles a group's values: it selects by radix
  (``selection.py``), from counts of leading bits per group.
* Histograms take min/max as scalar subqueries and bin with arithmetic, so
  the fact is read once and aggregated map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaar.operators.joins import lookup_join
from bazaar.operators.selection import radix_quantiles
from bazaar.sources.scratch import materialize


def _not_null(cols: list[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


exact_quantiles = radix_quantiles


def exact_median(df: DataFrame, keys: list[str], value: str, name: str = "median") -> DataFrame:
    return exact_quantiles(df, keys, value, [0.5], [name]).drop("n")


def median_by(df: DataFrame, keys: list[str], value: str, name: str = "median",
              approx: bool = False, accuracy: int = 10000) -> DataFrame:
    """Median per group: exact (``exact_median``) by default; with
    ``approx=True`` the bounded-memory ``percentile_approx`` sketch (an actual
    value of the group, rank error about 1/accuracy), one aggregation pass."""
    if not approx:
        return exact_median(df, keys, value, name)
    return df.where(_not_null(keys + [value])).groupBy(*keys).agg(
        F.percentile_approx(F.col(value).cast("double"), 0.5, accuracy).alias(name))


def distinct_count(c: str, approx: bool = False, rsd: float = 0.05) -> Column:
    """Exact ``count_distinct`` by default; ``approx=True`` uses the
    HyperLogLog++ sketch (relative standard deviation ``rsd``)."""
    return F.approx_count_distinct(c, rsd) if approx else F.count_distinct(c)


def histogram(df: DataFrame, value: str, bins: int, lo: Column | None = None,
              hi: Column | None = None, weight: str | None = None) -> DataFrame:
    """Equal-width histogram over [min, max] with ``bins`` bins, the last one
    closed (numpy semantics). Every bin is returned, empty ones with 0. ``weight`` names
    the number of rows that a row stands for.

    Columns: bin (0-based), bin_lo, bin_hi, count.
    """
    v = F.col(value)
    vals = df.where(v.isNotNull() & ~F.isnan(v.cast("double"))).select(
        v.cast("double").alias("_x"), (F.col(weight) if weight else F.lit(1)).alias("_w"))
    if lo is None or hi is None:
        # one scalar subquery (one pass) for both ends of the range
        rng = vals.agg(F.struct(F.min("_x").alias("lo"), F.max("_x").alias("hi"))).scalar()
        lo = rng.getField("lo") if lo is None else lo
        hi = rng.getField("hi") if hi is None else hi
    # numpy widens a zero range to [lo - 0.5, hi + 0.5]
    lo_ = F.when(lo == hi, lo - 0.5).otherwise(lo)
    hi_ = F.when(lo == hi, hi + 0.5).otherwise(hi)
    width = (hi_ - lo_) / bins
    norm = F.lit(float(bins)) / (hi_ - lo_)
    idx = F.least(F.floor((F.col("_x") - lo_) * norm).cast("int"), F.lit(bins - 1))
    counts = vals.where((F.col("_x") >= lo_) & (F.col("_x") <= hi_)) \
                 .groupBy(idx.alias("bin")).agg((F.sum("_w") if weight else F.count(F.lit(1))).alias("count"))
    grid = vals.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    out = grid.join(counts, "bin", "left").select(
        "bin", (lo_ + F.col("bin") * width).alias("bin_lo"),
        (lo_ + (F.col("bin") + 1) * width).alias("bin_hi"),
        F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"))
    return out


def fixed_edge_histogram(df: DataFrame, value: str, edges: list[float]) -> DataFrame:
    """Histogram on explicit ascending edges; bins are [e_i, e_{i+1}) except
    the last, which is closed. Values outside the edges are dropped.
    Columns: bin_lo, bin_hi, count (every bin, empty ones 0)."""
    v = F.col(value).cast("double")
    last = len(edges) - 2
    chain = None
    for i in range(len(edges) - 1):
        lo, hi = float(edges[i]), float(edges[i + 1])
        cond = (v >= lo) & ((v <= hi) if i == last else (v < hi))
        chain = F.when(cond, F.lit(i)) if chain is None else chain.when(cond, F.lit(i))
    counts = df.select(chain.alias("_b")).where(F.col("_b").isNotNull()) \
               .groupBy("_b").agg(F.count(F.lit(1)).alias("count"))
    spark = df.sparkSession
    grid = spark.createDataFrame([(i, float(edges[i]), float(edges[i + 1]))
                                  for i in range(len(edges) - 1)], "_b int, bin_lo double, bin_hi double")
    return grid.join(counts, "_b", "left").select(
        "bin_lo", "bin_hi", F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"))


def _box_of_counts(df: DataFrame, keys: list[str], value: str, whis: float) -> DataFrame:
    """``box_summary`` from one (group, value, count) table: one scan, nothing written."""
    v = F.col(value)
    counts = df.where(_not_null(keys + [value]) & ~F.isnan(v.cast("double"))) \
        .groupBy(*keys, v.cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    q = counts.groupBy(*keys).agg(F.sum("_c").alias("n"), F.percentile("_v", [0.25, 0.5, 0.75], F.col("_c")).alias("_q"))
    q = q.select(*keys, "n", *[F.get("_q", F.lit(i)).alias(name) for i, name in enumerate(("q1", "median", "q3"))])
    reach = whis * (F.col("q3") - F.col("q1"))
    inside = (F.col("_v") >= F.col("q1") - reach) & (F.col("_v") <= F.col("q3") + reach)
    return counts.join(q, keys).groupBy(*keys).agg(
        *[F.max(c).alias(c) for c in ("n", "q1", "median", "q3")],
        F.min(F.when(inside, F.col("_v"))).alias("whisker_lo"), F.max(F.when(inside, F.col("_v"))).alias("whisker_hi"),
        F.coalesce(F.sum(F.when(~inside, F.col("_c"))), F.lit(0)).alias("outliers"))


def box_summary(df: DataFrame, keys: list[str], value: str, whis: float = 1.5, few_values: bool = False) -> DataFrame:
    """Box-plot numbers per group: quartiles (linear), whiskers at the most
    extreme values inside [q1 - whis*IQR, q3 + whis*IQR], and outlier count.

    Columns: keys, n, q1, median, q3, whisker_lo, whisker_hi, outliers.
    ``few_values`` says that the domain bounds a group's distinct values (ratings): then everything
    comes from one table of their counts.
    """
    if few_values:
        return _box_of_counts(df, keys, value, whis)
    v = F.col(value)
    # the keys and the value, written once: read by the quantiles and by the join with the fences
    body = materialize(df.where(_not_null(keys + [value])).select(*keys, v.alias("_v")), "box-rows", codec="zstd")
    q = exact_quantiles(body, keys, "_v", [0.25, 0.5, 0.75], ["q1", "median", "q3"], written=True)
    # one row per group, written once: read by the fact join and the output
    fences = materialize(q.select(
        *keys, "n", "q1", "median", "q3",
        (F.col("q1") - whis * (F.col("q3") - F.col("q1"))).alias("_lf"),
        (F.col("q3") + whis * (F.col("q3") - F.col("q1"))).alias("_hf")), "fences")
    # broadcast after a size check, so the fact is not shuffled onto few keys
    joined = lookup_join(body, fences.select(*keys, "_lf", "_hf"), keys, "inner", written=True)
    inside = (F.col("_v") >= F.col("_lf")) & (F.col("_v") <= F.col("_hf"))
    w = joined.groupBy(*keys).agg(
        F.min(F.when(inside, F.col("_v"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("_v"))).alias("whisker_hi"),
        F.count_if(~inside).cast("long").alias("outliers"))
    return fences.drop("_lf", "_hf").join(w, keys)


def pearson(a: str, b: str) -> Column:
    """Pairwise-complete Pearson r; NULL when either side is constant
    (Spark's ``corr`` raises under ANSI mode on a zero variance)."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x = F.when(both, F.col(a).cast("double"))
    y = F.when(both, F.col(b).cast("double"))
    denom = F.stddev_samp(x) * F.stddev_samp(y)
    return F.try_divide(F.covar_samp(x, y), F.nullif(denom, F.lit(0.0)))


_PAIRS_AT_ONCE = 5      # pairs whose buffers (10 fields each) fit the codegen limit of 100 fields together


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Long-form matrix (col_a, col_b, r) of every ordered pair, diagonal
    included, from one pass over the fact.

    Each row is unpivoted into one row per ``_PAIRS_AT_ONCE`` pairs, and the groups of pairs
    are aggregated side by side: one wide aggregate over all pairs would leave
    whole-stage codegen. Partial aggregation leaves at
    most one row per group of pairs and task before the shuffle."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    groups = [pairs[at:at + _PAIRS_AT_ONCE] for at in range(0, len(pairs), _PAIRS_AT_ONCE)]
    spare = F.lit(None).cast("double")
    long = df.select(F.inline(F.array(*[F.struct(F.lit(g).alias("_g"), *[
        x for i in range(_PAIRS_AT_ONCE)
        for x in ((F.col(group[i][0]).cast("double").alias(f"_x{i}"), F.col(group[i][1]).cast("double").alias(f"_y{i}"))
                  if i < len(group) else (spare.alias(f"_x{i}"), spare.alias(f"_y{i}")))])
        for g, group in enumerate(groups)])))
    r = long.groupBy("_g").agg(*[pearson(f"_x{i}", f"_y{i}").alias(f"_r{i}") for i in range(_PAIRS_AT_ONCE)])
    cells = [F.struct(F.lit(g).alias("g"), F.lit(x).alias("col_a"), F.lit(y).alias("col_b"), F.col(f"_r{i}").alias("r"))
             for g, group in enumerate(groups) for i, (a, b) in enumerate(group)
             for x, y in ({(a, b), (b, a)})]
    return r.select("_g", F.inline(F.array(*cells))).where("g = _g").select("col_a", "col_b", "r")


def linear_forecast(points: DataFrame, x: str, y: str, horizon: int = 3,
                    min_points: int = 3) -> DataFrame:
    """Least-squares line through (x, y) and its value at max(x)+1..+horizon.
    Empty when fewer than ``min_points`` points. ``points`` is an aggregated
    table (one row per x)."""
    fit = points.agg(F.regr_slope(F.col(y), F.col(x)).alias("slope"),
                     F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
                     F.count(F.col(y)).alias("_n"), F.max(F.col(x)).cast("int").alias("_max"))
    out = fit.where(F.col("_n") >= min_points).select(
        "slope", "intercept",
        F.explode(F.sequence(F.col("_max") + 1, F.col("_max") + horizon)).alias(x))
    return out.select(F.col(x).cast("int").alias(x),
                      (F.col("intercept") + F.col("slope") * F.col(x)).alias(f"forecast_{y}"))


_PREFIX_DIGITS = 5      # hexadecimal digits of a sample's histogram: 2^20 buckets at most


def sample_rows(df: DataFrame, n: int, key: str, seed: int = 1) -> DataFrame:
    """At most ``n`` rows chosen by a seeded hash of ``key``: the same rows
    on any partitioning.

    The hash is the md5 of ``key || '#' || seed``, which SQL engines compute
    alike, so the sample can be checked against an oracle; rows that tie on
    the key are ordered by all remaining columns.

    A plain top-n keeps n candidates per task and merges them all in one
    place (tasks x n rows). Here the rows are first counted by the leading digits
    of their hash, whose order is the hash order; the first bucket by which n rows
    are reached is the cut (none, if there are fewer rows), and the top-n is taken of the rows
    up to it: n and one bucket, a millionth of the rows. One plan for every size,
    and nothing runs before the query does. A NULL key hashes like an empty one."""
    h = F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(f"#{seed}")))
    rest = [c for c in df.columns if c != key]
    prefix = F.substring(h, 1, _PREFIX_DIGITS)
    running = F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, 0))   # of the buckets
    cut = df.groupBy(prefix.alias("_p")).agg(F.count(F.lit(1)).alias("_n")).withColumn("_run", running) \
        .agg(F.min(F.when(F.col("_run") >= n, F.col("_p")))).scalar()
    return df.where(prefix <= F.coalesce(cut, F.lit("g"))).orderBy(h, F.col(key), *rest).limit(n)
