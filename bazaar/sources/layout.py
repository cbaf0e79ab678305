"""A layout that serves filters on several columns: a space-filling curve and Bloom filters.

Rows are written in the order of a Z-curve over the columns, so that every file and row group
covers a short range of each of them and the reader's minima and maxima skip the rest. A
column's place on the curve is its share of the rows below it (equi-depth), whatever its type
and however skewed. Ids get Bloom filters, which skip row groups for one id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaar.operators.joins import broadcast_threshold, lookup_join, measured_bytes
from bazaar.sources.scratch import materialize

BITS = 6                # of a column on the curve: 64 places
_IN_PARTITION = 33      # bits of a monotonically increasing id below the partition's number


def curve_places(df: DataFrame, col: str, bits: int = BITS) -> DataFrame:
    """(col, place): for every non-NULL value its place in 0 .. 2^bits - 1, which rises with the
    value; every place has about the same number of rows, up to values that are themselves larger.

    Sorted in ranges; the shares below a range are a running sum over one row per range.
    """
    return _places(df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n")), col, bits)


def _places(counts: DataFrame, col: str, bits: int) -> DataFrame:
    """:func:`curve_places` from the rows of every value (col, _n)."""
    counts = materialize(counts.orderBy(col).withColumn("_at", F.monotonically_increasing_id()), "curve") \
        .withColumn("_part", F.shiftright("_at", _IN_PARTITION))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    parts = counts.groupBy("_part").agg(F.sum("_n").alias("_m")).select(
        "_part", F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_off"), F.sum("_m").over(every).alias("_all"))
    inside = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    below = F.col("_off") + F.sum("_n").over(inside) - F.col("_n")
    return lookup_join(counts, parts, "_part", "inner", label="curve-parts") \
        .select(col, F.floor(below * F.lit(1 << bits) / F.col("_all")).cast("int").alias("place"))


def z_value(places: list[Column], bits: int = BITS) -> Column:
    """The places' bits interleaved, the highest first; of each level the first column's."""
    out = F.lit(0).cast("long")
    for bit in range(bits):
        for i, place in enumerate(places):
            one = F.shiftright(place, bit).bitwiseAND(F.lit(1)).cast("long")
            out = out + F.shiftleft(one, bit * len(places) + len(places) - 1 - i)
    return out


def _placed(df: DataFrame, col: str, places: DataFrame, name: str) -> DataFrame:
    """``df`` with the place of ``col`` as ``name`` (NULL for NULL). A table of values beyond the
    broadcast bound is cut down to the smallest value of every place, 2^bits rows: a place rises with
    the value, so these tell it, and the rows are not shuffled for a join with the values."""
    places = materialize(places.withColumnRenamed("place", name), "curve-places")
    bound = broadcast_threshold(df.sparkSession)
    if 0 <= measured_bytes(places) <= bound:
        return lookup_join(df, places, col, "left", written=True)
    cuts = places.groupBy(name).agg(F.min(col).alias("_from")) \
        .withColumn("_to", F.lead("_from").over(Window.orderBy(name)))
    inside = (F.col(col) >= F.col("_from")) & (F.col("_to").isNull() | (F.col(col) < F.col("_to")))
    return df.join(F.broadcast(cuts), inside, "left").drop("_from", "_to")


def along_curve(df: DataFrame, cols: list[str], first: list[str] | None = None, bits: int = BITS) -> DataFrame:
    """``df`` dealt and sorted by ``first``, then along the curve over ``cols``. A row hash ends
    the key, so a combination that holds a third of all rows spans many tasks. NULL is place 0.

    One aggregation counts the values of all ``cols``.
    """
    first, laid = first or [], df
    counts = materialize(df.groupingSets([[F.col(c)] for c in cols], *[F.col(c) for c in cols]).agg(
        F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("_n")), "curve-counts")
    for i, c in enumerate(cols):
        # bit i of the grouping id (from the left) is clear in the set of column i
        own = (1 << len(cols)) - 1 - (1 << (len(cols) - 1 - i))
        values = counts.where((F.col("_set") == own) & F.col(c).isNotNull()).select(c, "_n")
        laid = _placed(laid, c, _places(values, c, bits), f"_place{i}")
    plain = [F.col(f"`{c}`") for c in df.columns]
    laid = laid.select(*plain, z_value([F.coalesce(F.col(f"_place{i}"), F.lit(0)) for i in range(len(cols))], bits).alias("_z"))
    row_hash = F.xxhash64(*plain)
    return laid.repartitionByRange(*first, "_z", row_hash).sortWithinPartitions(*first, "_z", *cols).drop("_z")


def bloom_options(cols: list[str]) -> dict[str, str]:
    """Parquet writer options: a Bloom filter, sized to the values present, for each of ``cols``."""
    out = {"parquet.bloom.filter.adaptive.enabled": "true"} if cols else {}
    return out | {f"parquet.bloom.filter.enabled#{c}": "true" for c in cols}
