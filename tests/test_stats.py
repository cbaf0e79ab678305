"""Statistics against numpy / pandas on generated samples."""

import numpy as np
import pandas as pd
import pytest

from bazaar.operators import stats


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(7)
    n = 6000
    # one hot group holding about a third of the rows, plus repeats and NULLs
    g = rng.choice(["hot", "b", "c", "d"], size=n, p=[0.4, 0.3, 0.2, 0.1])
    v = np.round(rng.lognormal(5, 1.2, size=n), 1)
    v[rng.random(n) < 0.05] = np.nan
    pdf = pd.DataFrame({"g": g, "v": v})
    sdf = spark.createDataFrame([(a, None if np.isnan(b) else float(b)) for a, b in zip(g, v)], "g string, v double")
    return pdf, sdf


def test_exact_quantiles_match_pandas(spark, sample):
    pdf, sdf = sample
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = stats.exact_quantiles(sdf, ["g"], "v", probs).toPandas().set_index("g").sort_index()
    exp = pdf.dropna().groupby("g")["v"].quantile(probs).unstack().sort_index()
    for i, p in enumerate(probs):
        np.testing.assert_allclose(got[f"q{i}"].values, exp[p].values, rtol=1e-12)
    assert (got["n"].values == pdf.dropna().groupby("g")["v"].count().sort_index().values).all()


def test_exact_quantiles_global(spark, sample):
    pdf, sdf = sample
    got = stats.exact_quantiles(sdf, [], "v", [0.5], ["m"]).first()["m"]
    assert got == pytest.approx(pdf["v"].median())


def test_histogram_matches_numpy(spark, sample):
    pdf, sdf = sample
    got = stats.histogram(sdf, "v", 16).orderBy("bin").toPandas()
    counts, edges = np.histogram(pdf["v"].dropna(), bins=16)
    assert got["count"].tolist() == counts.tolist()
    np.testing.assert_allclose(got["bin_lo"].values, edges[:-1], rtol=1e-9)


def test_fixed_edge_histogram_matches_numpy(spark):
    vals = [1, 1, 2, 3, 18, 19, 20, 0, 5, 5, 5]
    sdf = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got = stats.fixed_edge_histogram(sdf, "x", list(range(1, 20))).orderBy("bin_lo").toPandas()
    counts, _ = np.histogram(vals, bins=range(1, 20))
    assert got["count"].tolist() == counts.tolist()


@pytest.mark.parametrize("few_values", [False, True])
def test_box_summary_matches_pandas(spark, sample, few_values):
    pdf, sdf = sample
    got = stats.box_summary(sdf, ["g"], "v", few_values=few_values).toPandas().set_index("g").sort_index()
    for g, s in pdf.dropna().groupby("g")["v"]:
        q1, q3 = s.quantile(0.25), s.quantile(0.75)
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = s[(s >= lo) & (s <= hi)]
        row = got.loc[g]
        assert row.whisker_lo == pytest.approx(inside.min())
        assert row.whisker_hi == pytest.approx(inside.max())
        assert row.outliers == len(s) - len(inside)
        assert row["median"] == pytest.approx(s.median())


def test_correlation_matrix_matches_pandas(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(size=500)
    b = a * 0.5 + rng.normal(size=500)
    c = np.where(rng.random(500) < 0.1, np.nan, rng.normal(size=500))
    k = np.ones(500)  # constant column -> NULL, not an error
    pdf = pd.DataFrame({"a": a, "b": b, "c": c, "k": k})
    sdf = spark.createDataFrame([tuple(None if np.isnan(x) else float(x) for x in r) for r in pdf.values],
                                "a double, b double, c double, k double")
    got = {(r.col_a, r.col_b): r.r for r in stats.correlation_matrix(sdf, ["a", "b", "c", "k"]).collect()}
    exp = pdf.corr()
    for x in "abc":
        for y in "abc":
            assert got[(x, y)] == pytest.approx(exp.loc[x, y], abs=1e-12)
    assert got[("a", "k")] is None and got[("k", "k")] is None


def test_linear_forecast_matches_polyfit(spark):
    xs, ys = [2015, 2016, 2017, 2018], [10.0, 12.5, 14.0, 18.0]
    pts = spark.createDataFrame(list(zip(xs, ys)), "order_year int, revenue double")
    got = stats.linear_forecast(pts, "order_year", "revenue").orderBy("order_year").collect()
    coef = np.polyfit(xs, ys, 1)
    assert [r.order_year for r in got] == [2019, 2020, 2021]
    for r in got:
        assert r.forecast_revenue == pytest.approx(np.polyval(coef, r.order_year))
    two = spark.createDataFrame([(2015, 1.0), (2016, 2.0)], "order_year int, revenue double")
    assert stats.linear_forecast(two, "order_year", "revenue").count() == 0


def test_sample_is_partitioning_independent(spark):
    df = spark.range(0, 5000).selectExpr("cast(id as string) as k")
    a = sorted(r.k for r in stats.sample_rows(df.repartition(3), 100, "k").collect())
    b = sorted(r.k for r in stats.sample_rows(df.repartition(11), 100, "k").collect())
    assert a == b and len(a) == 100


def test_approx_options_are_close_to_exact(spark):
    from pyspark.sql import functions as F
    df = spark.range(20000).select(
        F.when(F.col("id") % 10 < 4, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 3).cast("string")))
         .alias("k"),
        ((F.col("id") * 7919) % 10007).cast("double").alias("v"),
        (F.col("id") % 5000).cast("string").alias("c"))
    exact = {r.k: r.m for r in stats.median_by(df, ["k"], "v", "m").collect()}
    approx = {r.k: r.m for r in stats.median_by(df, ["k"], "v", "m", approx=True).collect()}
    assert exact.keys() == approx.keys()
    # rank error ~1/accuracy: the values span 0..10006
    assert all(abs(exact[k] - approx[k]) <= 0.01 * 10007 for k in exact)
    row = df.agg(stats.distinct_count("c").alias("e"), stats.distinct_count("c", approx=True).alias("a")).first()
    assert row.e == 5000 and abs(row.a - 5000) <= 0.15 * 5000


@pytest.mark.parametrize("n", [1, 25, 2999, 3000, 5000])
def test_sample_rows_equals_brute_force_md5_order(spark, n):
    import hashlib
    from pyspark.sql import functions as F
    df = spark.range(3000).select((F.col("id") % 1700).cast("string").alias("k"),
                                  (F.col("id") % 7).cast("double").alias("x"))
    got = [tuple(r) for r in stats.sample_rows(df, n, "k", seed=3).collect()]
    rows = [(str(i % 1700), float(i % 7)) for i in range(3000)]
    exp = sorted(rows, key=lambda r: (hashlib.md5(f"{r[0]}#3".encode()).hexdigest(), r[0], r[1]))[:n]
    assert sorted(got) == sorted(exp)
