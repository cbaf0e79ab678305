"""Report operators against pandas on a small frame with a hot customer
(40 % of all rows), NULL customers and NULL years."""

import math

import pandas as pd
import pytest

from bazaar.operators import reports as R


@pytest.fixture(scope="module")
def frame(spark):
    rows = []
    for i in range(200):
        cust = "C0" if i % 5 < 2 else (None if i % 23 == 0 else f"C{i % 17 + 1}")
        year = None if i % 31 == 0 else 2015 + (i * 7) % 5
        method = ["UPI", "Card", "COD"][i % 3] if year != 2016 else "UPI"
        rows.append((f"T{i}", cust, year, method, float(100 + i)))
    pdf = pd.DataFrame(rows, columns=["transaction_id", "customer_id", "order_year", "payment_method",
                                      "final_amount_inr"])
    sdf = spark.createDataFrame(rows, "transaction_id string, customer_id string, order_year int, "
                                      "payment_method string, final_amount_inr double")
    return pdf, sdf


def _cohort_ref(pdf):
    d = pdf.dropna(subset=["customer_id", "order_year"])
    first = d.groupby("customer_id")["order_year"].min().rename("cohort")
    d = d.join(first, on="customer_id")
    return d.groupby(["cohort", "order_year"])["customer_id"].nunique()


def test_cohort_counts_match_pandas(frame):
    pdf, sdf = frame
    exp = _cohort_ref(pdf)
    got = {(r.cohort, r.order_year): r.customers for r in R.cohort_counts(sdf).collect()}
    assert got == {(int(c), int(y)): int(n) for (c, y), n in exp.items()}


def test_cohort_retention_variants_match_pandas(frame):
    pdf, sdf = frame
    wide = _cohort_ref(pdf).unstack()
    own = {(c, y): wide.loc[c, y] / wide.loc[c, c] for c in wide.index for y in wide.columns
           if not math.isnan(wide.loc[c, y])}
    first_col = wide.div(wide.iloc[:, 0], axis=0)        # the source's division by the first column
    got = {(r.cohort, r.order_year): r.retention for r in R.cohort_retention(sdf).collect()}
    assert got.keys() == own.keys()
    assert all(got[k] == pytest.approx(v) for k, v in own.items())
    fy = {(r.cohort, r.order_year): r.retention for r in R.cohort_retention_first_year_base(sdf).collect()}
    for (c, y), v in fy.items():
        ref = first_col.loc[c, y]
        assert (v is None and math.isnan(ref)) or v == pytest.approx(ref)


def test_payment_share_zero_fills_like_a_categorical(frame):
    pdf, sdf = frame
    d = pdf.dropna(subset=["order_year", "payment_method"])
    exp = pd.crosstab(d["order_year"], d["payment_method"], normalize="index") * 100
    got = {(r.order_year, r.payment_method): r.share_pct for r in R.payment_share(sdf).collect()}
    assert len(got) == exp.size                       # observed years x observed methods
    for y in exp.index:
        for m in exp.columns:
            assert got[(int(y), m)] == pytest.approx(exp.loc[y, m])
    assert got[(2016, "Card")] == 0.0


def test_yoy_growth_matches_pct_change(frame):
    pdf, sdf = frame
    rev = pdf.dropna(subset=["order_year"]).groupby("order_year")["final_amount_inr"].sum()
    exp = rev.pct_change() * 100
    got = {r.order_year: r.growth_pct for r in R.yoy_growth(sdf).collect()}
    for y, v in exp.items():
        assert (got[int(y)] is None and math.isnan(v)) or got[int(y)] == pytest.approx(v)


def test_payment_share_has_no_pivot_cap(spark, frame):
    _, sdf = frame
    prev = spark.conf.get("spark.sql.pivotMaxValues")
    spark.conf.set("spark.sql.pivotMaxValues", "2")   # fewer than the three methods
    try:
        rows = R.payment_share(sdf).collect()
    finally:
        spark.conf.set("spark.sql.pivotMaxValues", prev)
    assert {r.payment_method for r in rows} == {"UPI", "Card", "COD"}


def test_category_lifecycle_wide_keeps_every_category(spark):
    from sf_paths import SF_SMALL
    from bazaar.plans import report_queries as Q
    from bazaar.sources.tables import sales
    rows = [(f"T{i}", 2015 + i % 2, f"c{i % 10}") for i in range(40)]
    wide = R.category_lifecycle_wide(spark.createDataFrame([(*r, 1.0) for r in rows], "transaction_id string, order_year int, category string, "
                                                           "final_amount_inr double"), [f"c{k}" for k in range(10)])
    assert wide.columns == ["order_year", *(f"c{k}" for k in range(10)), "Other"]
    assert all(r["Other"] is None for r in wide.collect())
    fact = sales(spark, SF_SMALL)
    assert {r[0] for r in fact.select("category").distinct().collect() if r[0]} <= set(Q._WIDE)
    assert all(r["Other"] is None for r in R.category_lifecycle_wide(fact, Q._WIDE).collect())
