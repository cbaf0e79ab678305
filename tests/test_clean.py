"""Cleaning operators: worked examples, the source's order-dependent rules,
round trips through defect injection, and invariants of the pipeline."""

from pyspark.sql import functions as F

from bazaar.operators import clean as C
from bazaar.operators import inject as G
from bazaar.schema import CATEGORY_VARIANTS, CITY_VARIANTS, PAYMENT_VARIANTS
from sf_paths import SF_CHECK

WINDOW = ("1995-01-01", "2001-12-31")


def test_rating_imputation_two_stage(spark):
    df = spark.createDataFrame(
        [(1, "A", "4"), (2, "A", "2"), (3, "A", None), (4, "B", None), (5, None, None), (6, "C", "5")],
        "seq int, product_id string, customer_rating string")
    out = {r.seq: r.customer_rating for r in C.impute_ratings(C.clean_ratings(df)).collect()}
    assert out[3] == 3.0                       # product median of {4, 2}
    # global median of the product-filled column {4, 2, 3, 5} = 3.5
    assert out[4] == 3.5 and out[5] == 3.5
    assert out[1] == 4.0 and out[6] == 5.0


def test_price_outliers(spark):
    df = spark.createDataFrame(
        [(1, "X", 100.0), (2, "X", 100.0), (3, "X", 100.0), (4, "X", 5001.0), (5, "X", 5000.0),
         (6, None, 99999.0)], "seq int, category string, original_price_inr double")
    out = {r.seq: r.original_price_inr for r in C.fix_price_outliers(df).collect()}
    assert out[4] == 50.01 and out[5] == 5000.0 and out[6] == 99999.0


def test_dedup_keep_first_and_null_ids(spark):
    df = spark.createDataFrame(
        [("a", 1, "first"), ("a", 2, "second"), ("b", 3, "only"), (None, 4, "n1"), (None, 5, "n2")],
        "transaction_id string, seq int, note string")
    out = sorted((r.transaction_id or "", r.note) for r in C.dedup_keep_first(df, order=["seq"]).collect())
    assert out == [("", "n1"), ("a", "first"), ("b", "only")]


def test_dedup_hot_key_is_combined_map_side(spark):
    df = spark.range(0, 20000).select(F.lit("hot").alias("transaction_id"), F.col("id").alias("seq"))
    out = C.dedup_keep_first(df, order=["seq"])
    assert out.collect()[0].seq == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan or "partial_" in plan


def test_dedup_carries_the_row_once(spark):
    """Where the order is the whole row, it is not shuffled a second time beside the row."""
    rows = [("a", 2, None, 1.5), ("a", None, "x", 2.5), ("a", None, "x", 0.5), (None, 7, "n", None), (None, 7, None, 3.0),
            ("b", 1, "y", 1.0), ("b", 1, "y", 1.0)]
    df = spark.createDataFrame(rows, "transaction_id string, seq int, note string, price double")
    want = {(None, 7, None, 3.0), ("a", None, "x", 0.5), ("b", 1, "y", 1.0)}        # NULLs come first
    out = C.dedup_keep_first(df)
    assert out.columns == df.columns and {tuple(r) for r in out.collect()} == want and out.count() == 3
    assert "min_by" not in out._jdf.queryExecution().executedPlan().toString()
    other = C.dedup_keep_first(df, order=["price", "seq", "note", "transaction_id"])  # another order, with the key
    assert {tuple(r) for r in other.collect()} == {(None, 7, "n", None), ("a", None, "x", 0.5), ("b", 1, "y", 1.0)}
    assert "min_by" in C.dedup_keep_first(df, order=["seq"])._jdf.queryExecution().executedPlan().toString()


def test_alias_round_trip(spark):
    """clean(inject(x)) == x for every canonical value with variants."""
    rows = [(i, c) for i, c in enumerate(list(CITY_VARIANTS) * 40)]
    df = spark.createDataFrame(rows, "k long, city string")
    dirty = df.select("k", "city", G.inject_aliases(F.col("city"), F.col("k"), CITY_VARIANTS, "city")
                      .alias("customer_city"))
    assert dirty.where(F.col("customer_city") != F.col("city")).count() > 0
    back = C.clean_cities(dirty)
    assert back.where(F.col("customer_city") != F.col("city")).count() == 0
    for variants, cleaner, col, salt in ((CATEGORY_VARIANTS, C.clean_categories, "category", "category"),
                                         (PAYMENT_VARIANTS, C.clean_payments, "payment_method", "payment")):
        rows = [(i, c) for i, c in enumerate(list(variants) * 40)]
        df = spark.createDataFrame(rows, "k long, truth string")
        dirty = df.select("k", "truth", G.inject_aliases(F.col("truth"), F.col("k"), variants, salt).alias(col))
        assert cleaner(dirty).where(F.col(col) != F.col("truth")).count() == 0


def test_boolean_round_trip(spark):
    df = spark.range(0, 2000).select(F.col("id").alias("k"), (F.col("id") % 3 == 0).alias("truth"))
    dirty = df.select("k", "truth", G.inject_booleans(F.col("truth"), F.col("k")).alias("is_prime_member"))
    back = C.clean_booleans(dirty)
    # blanks become False, everything else round-trips
    wrong = back.where((F.col("is_prime_member") != F.col("truth")))
    blanks = dirty.where(F.col("is_prime_member").isNull())
    assert wrong.count() == blanks.where(F.col("truth")).count()


def test_date_round_trip_unambiguous(spark):
    """Dates written by the injector parse back, except US-ordered ones with
    a day <= 12 (read day-first, as in the source)."""
    raw = G.messy(spark, SF_CHECK)
    from bazaar.sources.tables import table
    truth = table(spark, SF_CHECK, "orders").select(F.col("o_orderkey").alias("seq"),
                                                   F.col("o_orderdate").cast("date").alias("truth"))
    parsed = C.clean_dates(raw, window=WINDOW).join(truth, "seq")
    h = G.hash100(F.col("seq"), "date")
    us_ambiguous = (h >= 85) & (h < 93) & (F.dayofmonth("truth") <= 12)
    valid = h < 93
    bad = parsed.where(valid & ~us_ambiguous & ~F.col("order_date").eqNullSafe(F.col("truth")))
    assert bad.count() == 0


def test_pipeline_invariants(spark):
    res = C.clean_pipeline(G.raw(spark, SF_CHECK), window=WINDOW, order=["_copy", "seq"])
    df = res.clean
    n = df.count()
    assert df.select("transaction_id").distinct().count() == n
    ratings = {r[0] for r in df.select("customer_rating").distinct().collect()}
    assert ratings <= {1 + i * 0.25 for i in range(17)}
    assert df.where((F.col("delivery_days") < 0) | (F.col("delivery_days") > 15)
                    | F.col("delivery_days").isNull()).count() == 0
    assert df.where(F.col("is_prime_member").isNull() | F.col("is_festival_sale").isNull()).count() == 0
    assert df.where(F.col("order_date").isNull() | F.col("final_amount_inr").isNull()).count() == 0
    assert "_copy" not in df.columns
    rep = {r.step: r.detail for r in res.report.collect()}
    assert list(rep) == ["duplicates", "dropped_invalid", "rows", "null_pct"]
    assert rep["rows"].endswith(f"{n:,} clean")


def test_pipeline_same_answer_with_1_and_8_shuffle_partitions(spark):
    def run(parts):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        try:
            res = C.clean_pipeline(G.raw(spark, "/root/testdata/sf0.001"), window=WINDOW,
                                   order=["_copy", "seq"])
            return sorted(tuple(r) for r in res.clean.collect())
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert run(1) == run(8)


def test_category_median_join_never_shuffles_the_fact_by_category(spark):
    """The per-category medians are broadcast after a size check, so the
    fact is not hash-partitioned onto the handful of category keys."""
    raw = C.parse_all(G.messy(spark, SF_CHECK), WINDOW)
    out = C.fix_price_outliers(raw)
    out.write.format("noop").mode("overwrite").save()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [category" in plan
    assert "SortMergeJoin [category" not in plan
