"""Reports over states equal reports over the fact, whole and after any filter; one scan of the fact;
exact distinct counts that merge."""

import math
import os
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from bazaar.operators import dictionary as K
from bazaar.operators import reports as R
from bazaar.operators.report_states import FILTER_KEYS, SETS, ReportStates, report_states
from bazaar.plans import pipeline as P
from bazaar.sources.tables import sales
from sf_paths import SF_SMALL

ADDITIVE = {
    **{n: f for n, f in R.EDA_QUESTIONS.items() if n not in R.NOT_ADDITIVE},
    **{f.__name__: f for f in (
        R.revenue_by_year, R.category_revenue, R.orders_by_year, R.active_customers, R.quarterly_revenue, R.monthly_seasonality,
        R.aov_festival, R.aov_prime, R.age_spend, R.purchase_frequency_20, R.spending_tier_revenue, R.cohort_counts,
        R.cohort_retention, R.top_products, R.payment_mix, R.payment_evolution, R.revenue_forecast, R.top_states,
        R.brand_share_trend, R.headline_metrics, R.filter_options)},
    "wide": lambda df: R.category_lifecycle_wide(df, ["LARGE", "PROMO"]),
}
FILTERS = {
    "all": (None, None, None), "years": ((1996, 1998), None, None), "category": (None, ["PROMO", "SMALL"], None),
    "all three": ((1997, 1999), ["LARGE", "PROMO", "MEDIUM"], ["ASIA", "EUROPE"]), "one cell": ((1996, 1996), ["PROMO"], ["ASIA"]),
    "nothing": (None, [], None),
}


@pytest.fixture(scope="module")
def fact(spark, tmp_path_factory):
    """The small fact with NULLs in every key, a hot customer, missing and odd amounts."""
    h = F.pmod(F.xxhash64("transaction_id"), F.lit(97))
    df = sales(spark, SF_SMALL)
    df = df.withColumn("customer_id", F.when(h < 30, F.lit("hot")).when(h == 31, F.lit(None)).otherwise(F.col("customer_id")))
    for i, c in enumerate(["category", "customer_tier", "payment_method", "age_group", "brand", "customer_city", "delivery_days",
                           "customer_rating", "is_prime_member", "discount_percent", "order_year", "transaction_id"]):
        df = df.withColumn(c, F.when(h != 40 + i, F.col(c)))
    df = df.withColumn("final_amount_inr", F.when(h == 60, F.lit(None)).when(h == 61, F.lit(float("nan")))
                       .when(h == 62, 1e-7).otherwise(F.col("final_amount_inr")))
    path = str(tmp_path_factory.mktemp("states") / "fact")
    df.repartition(4).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def states(fact, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("states") / "states")
    ReportStates.build(fact, path)
    return ReportStates.open(fact.sparkSession, path)


def _rows(df):
    def norm(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else float(f"{v:.9e}") + 0.0
        return v
    cols = sorted(df.columns)
    return sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=str)


@pytest.mark.parametrize("name", sorted(ADDITIVE))
def test_report_over_states_equals_report_over_fact(fact, states, name):
    chosen = FILTERS if name in ("headline_metrics", "cohort_retention", "q20_business_health", "category_revenue", "revenue_forecast") \
        else {k: FILTERS[k] for k in ("all", "all three")}
    got, want = ADDITIVE[name](states), ADDITIVE[name](fact)
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)
    for args in chosen.values():
        got, want = ADDITIVE[name](R.global_filters(states, *args)), ADDITIVE[name](R.global_filters(fact, *args))
        assert _rows(got) == _rows(want)


def _scans(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return Counter(re.findall(r"Location: InMemoryFileIndex[^\n]*?/([a-z]+)\]", df._jdf.queryExecution().optimizedPlan().toString() + plan)
                   or re.findall(r"InMemoryFileIndex\([^)]*\)\[[^\]]*?/([a-z]+)[\],]", plan))


def test_one_scan_of_the_fact(fact, states):
    built = report_states(fact)
    plan = built._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and plan.count("Expand") == 1
    for name, fn in ADDITIVE.items():
        for frame in (states, R.global_filters(states, (1997, 1999), ["LARGE"], ["ASIA"])):
            files = {os.path.basename(os.path.dirname(f.split("report_set=")[0].rstrip("/")) if "report_set=" in f else os.path.dirname(f))
                     for f in fn(frame).inputFiles()}
            assert files <= {"states", "bits"}, (name, files)


def test_a_filtered_report_reads_one_set(states):
    plan = R.category_revenue(R.global_filters(states, (1997, 1999), ["LARGE"], None))._jdf.queryExecution().executedPlan().toString()
    assert "report_set" in plan and "PartitionFilters: [isnotnull(report_set" in plan.replace("\n", "")
    assert re.search(r"PushedFilters: \[[^\]]*order_year", plan)


def test_set_ids_name_every_set(fact):
    got = {r["report_set"]: r["n"] for r in report_states(fact).groupBy("report_set").agg(F.sum("rows").alias("n")).collect()}
    assert set(got) == set(SETS) and set(got.values()) == {fact.count()}


def test_sets_of_absent_columns_are_left_out(fact):
    few = fact.drop("customer_spending_tier", "brand")
    assert {r[0] for r in report_states(few).select("report_set").distinct().collect()} == set(SETS) - {"spending", "brand"}


@pytest.mark.parametrize("gone", [[], ["customer_spending_tier", "brand"]])
def test_joints_give_the_states_of_every_set(fact, monkeypatch, gone):
    from bazaar.operators import report_states as S
    few, repeated, plain = fact.drop(*gone), [], S._states_by
    want = _rows(report_states(few))
    monkeypatch.setattr(S, "_states_by", lambda rows, sets: repeated.append(len(sets)) or plain(rows, sets))
    table = ReportStates.build(few, customers=False).table.where(~F.col("report_set").startswith("joint-"))
    assert _rows(table) == want
    assert len(repeated) == 1 and repeated[0] <= 7      # the fact's rows are not repeated for each of the 13 sets


def test_dense_ids(spark):
    df = spark.createDataFrame([(f"c{i % 500}",) for i in range(3000)] + [(None,)], "c string").repartition(6)
    ids = sorted((r["c"], r["id"]) for r in K.dense_ids(df, "c").collect())
    assert [c for c, _ in ids] == sorted({f"c{i}" for i in range(500)}) and sorted(i for _, i in ids) == list(range(1, 501))
    assert K.dense_ids(df.where("false"), "c").collect() == []


def test_bitmaps_equal_count_distinct(spark, fact):
    wide = spark.range(70000).select(F.lit(1999).alias("order_year"), F.lit("A").alias("category"), F.lit("T").alias("customer_tier"),
                                     F.concat(F.lit("n"), "id").alias("customer_id"))       # three pieces of bits
    rows = fact.select(*FILTER_KEYS, "customer_id").unionByName(wide)
    bits = K.bitmaps(rows, FILTER_KEYS, "customer_id")
    assert bits.where("category = 'A'").select("bucket").distinct().count() >= 3
    for keys in ([], ["order_year"], ["category", "customer_tier"], FILTER_KEYS):
        want = rows.where("customer_id is not null").groupBy(*keys).agg(F.count_distinct("customer_id").alias("n"))
        assert _rows(K.union_counts(bits, keys, "n")) == _rows(want)
    assert "Expand" not in K.union_counts(bits, ["order_year"], "n")._jdf.queryExecution().optimizedPlan().toString()


def test_first_seen_counts(spark):
    rows = [(y, c) for c, years in {"a": [1, 3], "b": [1], "c": [3, 4], "d": [4], "e": [1, 3, 4], "f": [None, 4]}.items() for y in years]
    bits = K.bitmaps(spark.createDataFrame(rows, "y int, c string"), ["y"], "c")
    got = {(r["f"], r["y"]): r["n"] for r in K.first_seen_counts(bits, "y", "f", "n").collect()}
    assert got == {(1, 1): 3, (1, 3): 2, (1, 4): 1, (3, 3): 1, (3, 4): 1, (4, 4): 2}
    assert K.first_seen_counts(bits.where("false"), "y", "f", "n").collect() == []


def test_eda_stage_tables_equal_single_reports(spark, fact):
    ran = P.run_all(fact, states=ReportStates.build(fact))
    assert set(ran) == set(R.EDA_QUESTIONS)
    for name, frame in ran.items():
        assert _rows(frame) == _rows(R.EDA_QUESTIONS[name](fact)), name


def test_money_of_odd_amounts(spark):
    from bazaar.functions import money_avg, money_sum
    cases = [([4e-11] * 1000, 4e-8), ([1e29, 1.0], 1e29), ([float("inf"), 1.0], math.inf), ([float("nan"), 4.0], 4.0),
             ([None, 0.1, 0.2], 0.3), ([float("nan")], None), ([1e17, -1e17, 2.5], 2.5), ([0.0], 0.0)]
    for values, want in cases:
        df = spark.createDataFrame([(2020, "x", "c", v) for v in values], "order_year int, category string, customer_city string, "
                                                                          "final_amount_inr double").withColumn("customer_id", F.lit("a"))
        present = sum(1 for v in values if v is not None and not math.isnan(v))
        got = df.agg(money_sum("final_amount_inr").alias("s"), money_avg("final_amount_inr").alias("a")).first()
        kpi = R.run_kpi(df, "category_revenue").first()["revenue"]
        for total in (got["s"], kpi):
            assert (total is None and want is None) or total == pytest.approx(want)
        assert (got["a"] is None and not present) or got["a"] == pytest.approx(want / present)


def test_human_int(spark):
    from bazaar.functions import human_int
    values = [0.0, 999.4, -1500.0, 1500.0, 250000.0, -12345678.0, 99999.0, None]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select(human_int("v").alias("s")).collect()
    assert [r["s"] for r in rows] == ["0", "999", "-1.5 K", "1.5 K", "2.50 L", "-1.23 Cr", "100.0 K", None]
