"""Literal edge cases for every column expression (FIXTURES.md section 3)."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from bazaar import functions as Fn
from bazaar.schema import CATEGORY_CANONICAL, CITY_CANONICAL, PAYMENT_CANONICAL


def one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(expr(F.col("v")).alias("r")).first()["r"]


DATES = [
    ("2020-01-05", dt.date(2020, 1, 5)), ("2020-1-5", dt.date(2020, 1, 5)),
    ("05/11/2020", dt.date(2020, 11, 5)), ("5/3/2020", dt.date(2020, 3, 5)),
    ("05-11-20", dt.date(2020, 11, 5)), ("11/25/2020", dt.date(2020, 11, 25)),
    ("25/12/20", dt.date(2020, 12, 25)), (" 2020-01-05 ", dt.date(2020, 1, 5)),
    ("05-11-95", None), ("13/12/2030", None), ("31/02/2020", None), ("32/13/2020", None),
    ("00/00/0000", None), ("not available", None), ("", None), ("2020-01-05 10:00:00", None),
    (None, None),
]


@pytest.mark.parametrize("text,expected", DATES)
def test_parse_date_default_window(spark, text, expected):
    assert one(spark, Fn.parse_date, text) == expected


def test_parse_date_two_digit_year_pivot(spark):
    w = ("1995-01-01", "2001-12-31")
    assert one(spark, lambda c: Fn.parse_date(c, w), "05-11-95") == dt.date(1995, 11, 5)
    assert one(spark, lambda c: Fn.parse_date(c, w), "05-11-01") == dt.date(2001, 11, 5)
    # leap day survives the century shift
    assert one(spark, lambda c: Fn.parse_date(c, None), "29-02-96") == dt.date(1996, 2, 29)


PRICES = [("₹125,000", 125000.0), ("1,234.50", 1234.5), ("5", 5.0), ("-5", 5.0), ("1200.", 1200.0),
          ("9e6", 96.0), ("Price on Request", None), ("Rs. 1,200.00", None), (".", None), ("", None),
          (None, None)]


@pytest.mark.parametrize("text,expected", PRICES)
def test_parse_price(spark, text, expected):
    assert one(spark, Fn.parse_price, text) == expected


RATINGS = [("4 stars", 4.0), ("3/5", 3.0), ("2.5/5.0", 2.5), ("4.75 / 5", 5.0), ("1.25", 1.0),
           ("1.75", 2.0), ("0", 1.0), ("8/10", 5.0), ("4/50", 4.0), ("stars 4", None), ("..", None),
           ("", None), (None, None)]


@pytest.mark.parametrize("text,expected", RATINGS)
def test_parse_rating(spark, text, expected):
    assert one(spark, Fn.parse_rating, text) == expected


@pytest.mark.parametrize("text,expected", [
    ("banglore", "Bengaluru"), (" BOMBAY ", "Mumbai"), ("new delhi", "Delhi"), ("foo-bar", "Foo-Bar"),
    ("o'brien", "O'Brien"), ("navi mumbai", "Navi Mumbai"), ("a1b", "A1B"), (None, None)])
def test_cities(spark, text, expected):
    assert one(spark, lambda c: Fn.canonical_lookup(c, CITY_CANONICAL), text) == expected


@pytest.mark.parametrize("text,expected", [
    ("Yes", True), ("y", True), ("1", True), ("1.0", True), ("TRUE", True), ("No", False), ("n", False),
    ("0", False), ("0.0", False), ("false", False), ("maybe", False), ("", False), (None, False)])
def test_booleans(spark, text, expected):
    assert one(spark, Fn.to_bool, text) is expected


@pytest.mark.parametrize("text,expected", [
    ("Electronics & Accessories", "Electronics"), ("Apparel", "Fashion"),
    ("HOME AND KITCHEN", "Home & Kitchen"), ("books", "Books"), (None, None)])
def test_categories(spark, text, expected):
    assert one(spark, lambda c: Fn.canonical_lookup(c, CATEGORY_CANONICAL), text) == expected


@pytest.mark.parametrize("text,expected", [
    ("PhonePe", "UPI"), ("CC", "Credit Card"), ("C.O.D", "Cash on Delivery"), ("gift card", "Gift Card"),
    (None, "Unknown")])
def test_payments(spark, text, expected):
    assert one(spark, lambda c: Fn.canonical_lookup(c, PAYMENT_CANONICAL, "Unknown"), text) == expected


@pytest.mark.parametrize("text,abs_,null_,dec", [
    ("5", 5.0, 5.0, 5.0), ("Same Day", 0.0, 0.0, 0.0), ("1-2 days", 1.5, 1.5, 1.5),
    ("-2", 2.0, None, 2.0), ("5.0", 2.5, 2.5, 5.0), ("50", None, None, None), ("15", 15.0, 15.0, 15.0),
    ("16", None, None, None), ("soon", None, None, None), ("1-2-4 days", 7 / 3, 7 / 3, 7 / 3),
    (None, None, None, None)])
def test_delivery_days_modes(spark, text, abs_, null_, dec):
    assert one(spark, Fn.parse_delivery_days, text) == pytest.approx(abs_) if abs_ is not None \
        else one(spark, Fn.parse_delivery_days, text) is None
    got_null = one(spark, lambda c: Fn.parse_delivery_days(c, negatives="null"), text)
    got_dec = one(spark, lambda c: Fn.parse_delivery_days(c, decimals=True), text)
    assert (got_null is None) if null_ is None else got_null == pytest.approx(null_)
    assert (got_dec is None) if dec is None else got_dec == pytest.approx(dec)


@pytest.mark.parametrize("value,expected", [
    (-1.0, None), (0.0, "0%"), (0.5, "1-10%"), (10.0, "1-10%"), (10.5, "11-20%"), (20.0, "11-20%"),
    (30.0, "21-30%"), (31.0, "30%+"), (100.0, "30%+"), (101.0, None), (None, None)])
def test_discount_band(spark, value, expected):
    assert one(spark, Fn.discount_band, value, "double") == expected


@pytest.mark.parametrize("value,expected", [
    (12345678.0, "₹1.23 Cr"), (250000.0, "₹2.50 L"), (1234.0, "₹1,234"), (0.0, "₹0"),
    (12500000.0, "₹1.25 Cr"), (12345678901.0, "₹1234.57 Cr")])
def test_format_inr(spark, value, expected):
    assert one(spark, Fn.format_inr, value, "double") == expected


def test_title_case_matches_python(spark):
    samples = ["foo-bar", "o'brien", "a1b", "HELLO world", "x_y", "new  york", "émile zola", "3rd street"]
    df = spark.createDataFrame([(s,) for s in samples], "v string")
    got = [r["r"] for r in df.select(Fn.title_case("v").alias("r")).collect()]
    assert got == [s.title() for s in samples]


def test_strip_matches_python(spark):
    samples = [" a ", "\tb\n", " c ", "d"]
    df = spark.createDataFrame([(s,) for s in samples], "v string")
    got = [r["r"] for r in df.select(Fn.strip_ws("v").alias("r")).collect()]
    assert got == [s.strip() for s in samples]


def test_no_python_udf_in_parsers(spark):
    df = spark.createDataFrame([("x",)], "v string")
    plan = df.select(Fn.parse_date("v"), Fn.parse_price("v"), Fn.parse_rating("v"),
                     Fn.parse_delivery_days("v"), Fn.to_bool("v"),
                     Fn.canonical_lookup("v", CITY_CANONICAL))._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def _python_parse_date(text):
    """Reference: formats in order, first success wins, Python %y pivot."""
    shapes = [(r"\d{4}-\d{1,2}-\d{1,2}", "%Y-%m-%d"), (r"\d{1,2}/\d{1,2}/\d{4}", "%d/%m/%Y"),
              (r"\d{1,2}-\d{1,2}-\d{2}", "%d-%m-%y"), (r"\d{1,2}/\d{1,2}/\d{4}", "%m/%d/%Y"),
              (r"\d{1,2}/\d{1,2}/\d{2}", "%d/%m/%y")]
    s = text.strip()
    for rx, fmt in shapes:
        if re.fullmatch(rx, s):
            try:
                return dt.datetime.strptime(s, fmt).date()
            except ValueError:
                continue
    return None


def test_parse_date_grid_matches_python(spark):
    days, months = ["0", "1", "05", "12", "13", "29", "30", "31", "32"], ["0", "2", "02", "11", "12", "13"]
    years4, years2 = ["0000", "1969", "1996", "2000", "2020", "2068"], ["00", "20", "68", "69", "95", "96"]
    texts = []
    for d in days:
        for m in months:
            for y in years4:
                texts += [f"{y}-{m}-{d}", f"{d}/{m}/{y}", f"{m}/{d}/{y}", f"{d}-{m}-{y}"]
            for y in years2:
                texts += [f"{d}-{m}-{y}", f"{d}/{m}/{y}", f"{d}-{m}/{y}", f"{d}/{m}-{y}"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = {r["v"]: r["d"] for r in df.select("v", Fn.parse_date("v", None).alias("d")).collect()}
    bad = [(t, got[t], _python_parse_date(t)) for t in texts if got[t] != _python_parse_date(t)]
    assert not bad, bad[:10]


def test_money_limbs_sum_like_money_parts(spark):
    from pyspark.sql import functions as F
    from bazaar.functions import money_limbs, money_of_limbs, money_parts
    values = [0.0, 1e-4, -1e-4, 9e-5, 99999998.99, 99999999.0, 1e8, -123456789.12, 9.999999999999998e16, 1e17, 12.3456, None,
              float("inf"), float("nan"), -31234567890123.25]
    df = spark.createDataFrame(list(enumerate(values)), "g int, v double")
    exact, odd = money_parts("v")
    limbs, rest = money_limbs("v")
    parts = df.select("g", *[x.alias(f"l{i}") for i, x in enumerate(limbs)], rest.alias("o"))
    sums = money_of_limbs(*[F.sum(f"l{i}") for i in range(3)])
    for keys in ([], ["g"]):
        want = {tuple(r) for r in df.groupBy(*keys).agg(exact.alias("e"), odd.alias("o")).collect()}
        assert {tuple(r) for r in parts.groupBy(*keys).agg(sums.alias("e"), F.sum("o").alias("o")).collect()} == want


def test_money_of_limbs_where_one_bigint_ends(spark):
    """The sums of one BIGINT of units and those beyond it agree with decimal arithmetic, and the
    first take one decimal operation."""
    from decimal import Decimal
    from bazaar.functions import money_of_limbs
    edges = [0, 1, -1, 10 ** 8 - 1, 10 ** 8, -10 ** 8, 10 ** 8 + 1, 10 ** 17 - 1, 10 ** 17, -10 ** 17 + 1, -10 ** 17, 9 * 10 ** 17]
    rows = [(a, b, c) for a in edges for b in edges for c in (0, 1, -3)] + [(None, None, None)]
    df = spark.createDataFrame(rows, "a long, b long, c long")
    out = df.select("*", money_of_limbs(F.col("a"), F.col("b"), F.col("c")).alias("m"))
    assert out.schema["m"].dataType.simpleString() == "decimal(38,10)"
    for a, b, c, m in out.collect():
        want = None if a is None else (a + b * 10 ** 9 + c * 10 ** 18)
        assert (m is None) == (want is None) and (m is None or int(m * Decimal(10 ** 10)) == want), (a, b, c, m)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "decimal(18,0)" in plan
