"""Dense numbers for the values of a column, and exact distinct counts that merge.

Ids are numbered 1..n once; a set of ids is then a bitmap, kept in pieces of 32,768
bits. ``count_distinct`` cannot be added up over years or filters, unions of bitmaps can.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaar.operators.joins import lookup_join
from bazaar.sources.scratch import materialize

_IN_PARTITION = 33      # bits of a monotonically increasing id below the partition's number


def dense_ids(df: DataFrame, col: str, name: str = "id") -> DataFrame:
    """(col, name): every distinct non-NULL value and its number from 1, without gaps.

    The values are written once with their place in their partition; the partitions'
    offsets are a running sum over one row per partition.
    """
    place = F.monotonically_increasing_id()
    values = materialize(df.where(F.col(col).isNotNull()).select(col).distinct().withColumn("_place", place), "dictionary") \
        .withColumn("_part", F.shiftright("_place", _IN_PARTITION))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = values.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")) \
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    row = F.col("_place").bitwiseAND(F.lit((1 << _IN_PARTITION) - 1))
    return lookup_join(values, offsets, "_part", "inner", label="dictionary-offsets") \
        .select(col, (F.col("_off") + row + 1).alias(name))


def bitmaps(members: DataFrame, keys: list[str], col: str) -> DataFrame:
    """(keys, bucket, bits): the set of ``col``'s dense numbers in every group of ``members``.

    A repeated (group, value) sets the same bit, so a value holding a third of all rows costs no
    more than it does in any aggregation: it is reduced in every task before the shuffle.
    """
    distinct = members.where(F.col(col).isNotNull()).select(*keys, col).distinct()
    ids = dense_ids(distinct, col, "_id")
    return distinct.join(ids, col).groupBy(*keys, F.bitmap_bucket_number("_id").alias("bucket")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias("bits"))


def union_counts(bits: DataFrame, keys: list[str], name: str) -> DataFrame:
    """(keys, name): size of the union of all sets of a group of ``keys``."""
    union = bits.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return union.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))


def first_seen_counts(bits: DataFrame, key: str, first: str, name: str) -> DataFrame:
    """(first, key, name): members of the set of ``key`` that were first seen in the set of ``first``.

    From unions alone: with U(c) the union of the sets before c and f(c, y) = |U(c) + set(y)|,
    the members first seen in c and present in y number f(c', y) subtracted from
    |U(c')| + f(c, y) - |U(c)|, where U(c') also holds c. ``key`` has a bounded number of values
    (years); every bucket of bits needs one row per pair of them.
    """
    sets = bits.where(F.col(key).isNotNull()).groupBy("bucket", key).agg(F.bitmap_or_agg("bits").alias("bits"))
    values = sets.agg(F.array_sort(F.collect_set(key))).scalar()
    place = F.array_position(values, F.col(key)).cast("int")
    # the set at place v belongs to f(c, y), c <= y, when v < c or v = y; places begin with 1
    wanted = sets.select("bucket", "bits", place.alias("v"), F.explode(F.sequence(F.lit(1), F.size(values))).alias("y")) \
        .select("*", F.explode(F.sequence(F.lit(1), F.col("y"))).alias("c")).where("v < c or v = y")
    unions = wanted.groupBy("bucket", "c", "y").agg(F.bitmap_or_agg("bits").alias("bits"))
    f = unions.groupBy("c", "y").agg(F.sum(F.bitmap_count("bits")).alias("f"))
    # years x years rows from here on
    along = Window.partitionBy("y").orderBy("c")
    f = f.withColumn("next", F.lead("f").over(along))                                   # f(c', y)
    before = F.coalesce(F.lag("f").over(Window.partitionBy(F.col("c") - F.col("y")).orderBy("c")), F.lit(0))
    diagonal = f.where("c = y").select(F.col("c").alias("at"), F.col("f").alias("with"),
                                       before.alias("before"))                           # |U(c')| and |U(c)|
    out = f.join(diagonal, F.col("c") == F.col("at")).select(
        "c", "y", F.when(F.col("c") == F.col("y"), F.col("with") - F.col("before"))
        .otherwise(F.col("with") + F.col("f") - F.col("next") - F.col("before")).alias(name))
    return out.where(F.col(name) > 0).select(
        F.element_at(values, F.col("c")).alias(first), F.element_at(values, F.col("y")).alias(key), name)
