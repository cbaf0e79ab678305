"""Radix selection: keys in the order of doubles, quantiles equal to pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from bazaar.operators import selection as S
from bazaar.operators import stats


def test_order_key_never_falls(spark):
    rng = np.random.default_rng(1)
    bits = rng.integers(1, 2047 << 52, 4000, dtype=np.int64)
    values = np.concatenate([bits.view(np.float64), rng.lognormal(5, 2, 4000), 2.0 ** np.arange(-1074, 1024),
                             np.nextafter(2.0 ** np.arange(-1021, 1024), 0), np.nextafter(2.0 ** np.arange(-1022, 1023), np.inf),
                             [0.0, 5e-324, 1.7976931348623157e308, np.inf, 0.1, 1 / 3]])
    values = np.unique(np.concatenate([values, -values]))
    df = spark.createDataFrame(pd.DataFrame({"v": values})).repartition(3)
    got = {r["v"]: r["k"] for r in df.select("v", S.order_key(F.col("v")).alias("k")).collect()}
    keys = np.array([got[float(v)] for v in values])
    assert (np.diff(keys) >= 0).all() and (keys[values < 0] < 0).all() and (keys[values > 0] > 0).all() and got[0.0] == 0
    apart = (np.diff(values) > 1e-9 * np.abs(values[1:])) & np.isfinite(values[1:]) & np.isfinite(values[:-1])
    assert (np.diff(keys >> S.SHIFTS[1])[apart] >= 0).all() and (np.diff(keys)[apart] > 0).all()


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(2)
    n = 20000
    g = rng.choice(["hot", "b", "c", "ties", "one"], n, p=[0.5, 0.2, 0.2, 0.0999, 0.0001])
    v = rng.lognormal(6, 2, n) * rng.choice([1, -1], n, p=[0.9, 0.1])
    v[g == "ties"] = rng.integers(0, 3, (g == "ties").sum())
    v[rng.random(n) < 0.02] = np.nan
    v[:40] = [np.inf, -np.inf, 0.0, -0.0, 1e308, -1e308, 5e-324, 1e-300] * 5
    pdf = pd.DataFrame({"g": g, "v": v})
    pdf.loc[100:140, "g"] = None
    rows = [(a, float(b), 1) for a, b in zip(pdf["g"], pdf["v"])]
    rows += [("hot", None, 1)] * 5
    return pdf, spark.createDataFrame(rows, "g string, v double, _k int").repartition(5)


PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]


def test_quantiles_equal_pandas(table):
    pdf, sdf = table
    got = S.radix_quantiles(sdf, ["g"], "v", PROBS).toPandas().set_index("g").sort_index()
    clean = pdf.dropna()
    assert (got["n"] == clean.groupby("g")["v"].count()).all()
    for g, s in clean.groupby("g")["v"]:
        values = np.sort(s.values)
        for i, p in enumerate(PROBS):
            h = (len(values) - 1) * p
            a, b = values[int(h)], values[min(int(h) + 1, len(values) - 1)]
            want = a if a == b else a + (b - a) * (h - int(h))
            assert got.loc[g, f"q{i}"] == pytest.approx(want, rel=1e-12, nan_ok=True), (g, p)


def test_global_named_empty_and_single(spark, table):
    pdf, sdf = table
    row = S.radix_quantiles(sdf, [], "v", [0.5], ["m"]).first()
    assert row["m"] == pytest.approx(pdf["v"].median()) and row["n"] == pdf["v"].count()
    assert S.radix_quantiles(sdf.where("false"), ["g"], "v", [0.5]).collect() == []
    one = spark.createDataFrame([(1, 7)], "k int, v int")
    assert [tuple(r) for r in S.radix_quantiles(one, ["k"], "v", [0.0, 0.5, 1.0]).collect()] == [(1, 1, 7.0, 7.0, 7.0)]


def test_shuffled_rows_are_buckets(spark):
    """A third of a million distinct values of two groups: rounds shuffle counts of buckets only."""
    df = spark.range(300000).select((F.col("id") % 2).alias("g"), (F.col("id") / 7 + 100).alias("v"))
    key = S.order_key(F.col("v"))
    buckets = df.select("g", F.shiftright(key, S.SHIFTS[0]).alias("b")).distinct().count()
    assert buckets < 12000                      # 256 a factor of two
    got = {r["g"]: r["q0"] for r in S.radix_quantiles(df, ["g"], "v", [0.5]).collect()}
    assert got == {0: pytest.approx(149999 / 7 + 100), 1: pytest.approx(150000 / 7 + 100)}


def test_box_reads_no_values_twice_into_a_shuffle(table):
    pdf, sdf = table
    got = stats.box_summary(sdf.where("abs(v) < 1e300"), ["g"], "v").toPandas().set_index("g")
    for g, s in pdf[pdf["v"].abs() < 1e300].dropna().groupby("g")["v"]:
        q1, q3 = s.quantile(0.25), s.quantile(0.75)
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = s[(s >= lo) & (s <= hi)]
        assert got.loc[g, "outliers"] == len(s) - len(inside)
        assert got.loc[g, "whisker_lo"] == inside.min() and got.loc[g, "whisker_hi"] == inside.max()


def test_the_input_is_made_once(spark):
    """A join below the quantiles and the box runs once: the values come from a written copy."""
    made = spark.sparkContext.accumulator(0)
    src = spark.createDataFrame([(g, float(i)) for g in "ab" for i in range(50)], "g string, v double")

    def seen(it):
        for batch in it:
            made.add(batch.num_rows)
            yield batch
    df = src.mapInArrow(seen, src.schema)
    got = {r["g"]: r["q0"] for r in S.radix_quantiles(df, ["g"], "v", [0.5]).collect()}
    assert got == {"a": 24.5, "b": 24.5} and made.value == 100
    assert {r["g"]: r["outliers"] for r in stats.box_summary(df, ["g"], "v").collect()} == {"a": 0, "b": 0}
    assert made.value == 200
