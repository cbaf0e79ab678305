"""Size-checked lookup joins: broadcast under the bound, shuffle join beyond."""

import pytest
from pyspark.sql import functions as F

from bazaar.operators.joins import lookup_join, measured_bytes, parse_bytes


@pytest.mark.parametrize("text,expected", [("10485760b", 10485760), ("10MB", 10 << 20), ("1g", 1 << 30),
                                           ("-1", -1), ("512", 512)])
def test_parse_bytes(text, expected):
    assert parse_bytes(text) == expected


def _fact(spark):
    # key 0 holds 40 % of the rows (a hot key), NULL keys included
    return spark.range(5000).select(
        F.when(F.col("id") % 5 < 2, F.lit("k0")).when(F.col("id") % 97 == 1, F.lit(None))
         .otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("key"),
        F.col("id").cast("double").alias("v"))


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_lookup_is_broadcast(spark):
    fact = _fact(spark)
    med = fact.where(F.col("key").isNotNull()).groupBy("key").agg(F.median("v").alias("m"))
    out = lookup_join(fact, med, "key", "left")
    assert "BroadcastHashJoin" in _plan(out)
    assert out.count() == 5000


def test_lookup_beyond_bound_is_shuffled_and_equal(spark):
    fact = _fact(spark)
    med = fact.where(F.col("key").isNotNull()).groupBy("key").agg(F.median("v").alias("m"))
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = lookup_join(fact, med, "key", "left")
        plan = _plan(shuffled)
        rows_shuffled = sorted(shuffled.collect(), key=lambda r: (r.v,))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    broadcast = sorted(lookup_join(fact, med, "key", "left").collect(), key=lambda r: (r.v,))
    assert rows_shuffled == broadcast
    pdf = fact.toPandas()
    exp = pdf.merge(pdf.dropna().groupby("key")["v"].median().rename("m").reset_index(), on="key", how="left")
    got = {r.v: r.m for r in broadcast}
    assert all((got[v] is None and m != m) or got[v] == m for v, m in zip(exp["v"], exp["m"]))


def test_measured_bytes_grows_with_strings(spark):
    a = spark.createDataFrame([("x", 1.0)] * 10, "k string, v double")
    b = spark.createDataFrame([("x" * 100, 1.0)] * 10, "k string, v double")
    assert measured_bytes(b) > measured_bytes(a) > 0


def test_salted_join_without_aqe_skew_is_exact(spark):
    fact = _fact(spark)
    med = fact.where(F.col("key").isNotNull()).groupBy("key").agg(F.median("v").alias("m"))
    expected = sorted(lookup_join(fact, med, "key", "left").collect(), key=lambda r: r.v)
    prev = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                           "spark.sql.adaptive.skewJoin.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        out = lookup_join(fact, med, "key", "left")
        plan = _plan(out)
        got = sorted(out.collect(), key=lambda r: r.v)
        inner = lookup_join(fact, med, "key", "inner").count()
    finally:
        for k, v in prev.items():
            spark.conf.set(k, v)
    assert "_salt" in plan and "SortMergeJoin" in plan
    assert got == expected and len(got) == 5000
    assert inner == fact.where(F.col("key").isNotNull()).count()


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_multi_column_key_equals_plain_join(spark, how):
    from bazaar.operators.joins import salted_join
    fact = spark.range(2000).select((F.col("id") % 3).alias("a"), (F.col("id") % 2).alias("b"),
                                    F.col("id").alias("v"))
    look = spark.createDataFrame([(0, 0, "x"), (1, 1, "y"), (2, 0, "z")], "a long, b long, t string")
    plain = sorted(tuple(r) for r in fact.join(look, ["a", "b"], how).collect())
    salted = sorted(tuple(r) for r in salted_join(fact, look, ["a", "b"], how, 7).collect())
    assert plain == salted


def _scans_of_lineitem(spark, build):
    """How often the jobs of ``build`` scan the line items, from the plans of its queries."""
    import pyspark.sql.readwriter as rw
    count, plain = [0], rw.DataFrameWriter.parquet

    def parquet(self, path, *args, **kw):
        count[0] += self._df._jdf.queryExecution().optimizedPlan().toString().count("l_orderkey") > 0
        return plain(self, path, *args, **kw)
    rw.DataFrameWriter.parquet = parquet
    try:
        out = build()
    finally:
        rw.DataFrameWriter.parquet = plain
    return count[0], "l_orderkey" in out._jdf.queryExecution().optimizedPlan().toString()


def test_queries_of_several_passes_join_the_fact_once(spark):
    from bazaar.plans import catalog
    from sf_paths import SF_SMALL
    for name in ("pk_violations", "keep_first_loads", "price_box_by_category", "category_median_price"):
        assert _scans_of_lineitem(spark, lambda: catalog.queries()[name](spark, SF_SMALL)) == (1, False), name


def test_line_items_are_joined_with_placed_orders(spark):
    """Orders meet their customers before the line items, which are shuffled by part and by order only."""
    import re
    from bazaar.sources.tables import sales
    from sf_paths import SF_SMALL
    plan = sales(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    joins = re.findall(r"Join Inner, \(+([a-z]_[a-z]+)#\d+L? = ([a-z]_[a-z]+)#", plan)
    assert joins[:2] == [("l_orderkey", "o_orderkey"), ("l_partkey", "p_partkey")] and ("o_custkey", "c_custkey") in joins
