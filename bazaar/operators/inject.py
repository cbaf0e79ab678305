"""Reproducible defect injection: take clean columns and dirty them the way
the raw yearly files are dirty (mixed date formats, price text, rating text,
boolean spellings, delivery text, alias spellings, duplicate rows).

Every choice is driven by an integer hash of the row key, ``((key mod p) * a)
mod p mod 100``, so there is no random state, results do not depend on
partitioning, and the oracle SQL can compute the very same values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.schema import (
    CATEGORIES, CATEGORY_VARIANTS, CITY_TIERS, CITY_VARIANTS, PAYMENT_METHODS, PAYMENT_VARIANTS,
)
from bazaar.functions.text import _col

# (multiplier, modulus) pairs: one independent hash stream per defect.
SALT = {
    "date": (7919, 9973), "price": (6151, 9967), "rating": (4099, 9949), "rating_value": (3571, 9941),
    "prime": (2953, 9931), "festival": (2311, 9929), "delivery": (1931, 9923),
    "delivery_aux": (1597, 9907), "amount": (1297, 9901), "city": (1103, 9887),
    "category": (983, 9883), "payment": (887, 9871), "dup": (5237, 9859),
}
CITIES = list(CITY_TIERS)


def hash100(key: Column | str, salt: str) -> Column:
    a, p = SALT[salt]
    # reduce first: (k mod p) * a never overflows, and equals (k * a) mod p
    return F.pmod(F.pmod(_col(key).cast("long"), F.lit(p)) * a, F.lit(p)) % 100


def _sql_hash(key: str, salt: str) -> str:
    a, p = SALT[salt]
    return f"(((({key}) % {p}) * {a}) % {p} % 100)"


# --------------------------------------------------------------------------- #
# G1-G7 as column / frame operators
# --------------------------------------------------------------------------- #
def inject_dates(date: Column, key: Column) -> Column:
    """30 % d/m/Y, 25 % d-m-y, 30 % Y-m-d, 8 % m/d/Y (US), 7 % invalid text."""
    h = hash100(key, "date")
    return (F.when(h < 30, F.date_format(date, "dd/MM/yyyy"))
             .when(h < 55, F.date_format(date, "dd-MM-yy"))
             .when(h < 85, F.date_format(date, "yyyy-MM-dd"))
             .when(h < 93, F.date_format(date, "MM/dd/yyyy"))
             .when(h < 95, F.lit("32/13/2020"))
             .when(h < 97, F.lit("00/00/0000"))
             .when(h < 99, F.lit("not available"))
             .otherwise(F.lit("")))


def inject_prices(price: Column, key: Column) -> Column:
    """35 % '₹12,345', 15 % '12,345.60', 8 % 'Price on Request',
    5 % a x100 decimal error, 37 % plain '12345.60'."""
    h = hash100(key, "price")
    whole = F.floor(price).cast("long")
    return (F.when(h < 35, F.concat(F.lit("₹"), F.format_number(whole, 0)))
             .when(h < 50, F.format_number(price, 2))
             .when(h < 58, F.lit("Price on Request"))
             .when(h < 63, (whole * 100).cast("string"))
             .otherwise(F.call_function("format_number", price, F.lit("0.00"))))


def true_rating(key: Column) -> Column:
    return F.lit(1.0) + (hash100(key, "rating_value") % 9) * 0.5


def inject_ratings(rating: Column, key: Column) -> Column:
    """20 % blank, 20 % 'n stars', 15 % 'n/5', 15 % 'x/5.0', 30 % 'x'."""
    h = hash100(key, "rating")
    whole = F.bround(rating, 0).cast("int").cast("string")
    return (F.when(h < 20, F.lit(None).cast("string"))
             .when(h < 40, F.concat(whole, F.lit(" stars")))
             .when(h < 55, F.concat(whole, F.lit("/5")))
             .when(h < 70, F.concat(rating.cast("string"), F.lit("/5.0")))
             .otherwise(rating.cast("string")))


def inject_booleans(flag: Column, key: Column, salt: str = "prime") -> Column:
    """Five spellings: True/False, Yes/No, 1/0, Y/N, and blank (30 % of the
    blank style is missing, the rest falls back to True/False)."""
    h = hash100(key, salt)
    style = h % 5
    tf = F.when(flag, F.lit("True")).otherwise(F.lit("False"))
    return (F.when(style == 1, F.when(flag, F.lit("Yes")).otherwise(F.lit("No")))
             .when(style == 2, F.when(flag, F.lit("1")).otherwise(F.lit("0")))
             .when(style == 3, F.when(flag, F.lit("Y")).otherwise(F.lit("N")))
             .when((style == 4) & (F.floor(h / 5) % 10 < 3), F.lit(None).cast("string"))
             .otherwise(tf))


def inject_delivery(days: Column, key: Column) -> Column:
    """70 % plain days, 10 % 'Same Day', 8 % 'a-b days', 6 % negative,
    6 % 50 / 99 / missing."""
    h = hash100(key, "delivery")
    aux = hash100(key, "delivery_aux")
    return (F.when(h < 70, days.cast("int").cast("string"))
             .when(h < 80, F.lit("Same Day"))
             .when(h < 88, F.concat((1 + aux % 3).cast("string"), F.lit("-"),
                                    (4 + aux % 3).cast("string"), F.lit(" days")))
             .when(h < 94, F.concat(F.lit("-"), (1 + aux % 3).cast("string")))
             .when(aux % 3 == 0, F.lit("50"))
             .when(aux % 3 == 1, F.lit("99"))
             .otherwise(F.lit(None).cast("string")))


def inject_aliases(canonical: Column, key: Column, variants: dict[str, list[str]],
                   salt: str, rate: int = 45, case_noise: int = 10) -> Column:
    """With probability ``rate`` % swap a canonical value for one of its
    variants; values without variants are upper-cased ``case_noise`` % of the
    time (so the Title-Case fallback has work)."""
    h = hash100(key, salt)
    out = None
    for canon, vs in variants.items():
        pick = F.element_at(F.array(*[F.lit(v) for v in vs]),
                            (F.pmod(_col(key).cast("long"), F.lit(len(vs))) + 1).cast("int"))
        cond = (canonical == canon) & (h < rate)
        out = F.when(cond, pick) if out is None else out.when(cond, pick)
    known = canonical.isin(*variants.keys())
    out = out.when(~known & (h < case_noise), F.upper(canonical))
    return out.otherwise(canonical)


def inject_duplicates(df: DataFrame, key: str, pct: int = 3) -> DataFrame:
    """Append an exact copy of ``pct`` % of the rows (``_copy`` = 1 marks the
    copies, which sort after the originals)."""
    base = df.withColumn("_copy", F.lit(0))
    dups = df.where(hash100(key, "dup") < pct).withColumn("_copy", F.lit(1))
    return base.unionByName(dups)


def dirty(df: DataFrame, key: Column | None = None) -> DataFrame:
    """G1-G6 on a clean fact with the dictionary's columns: every cleanable
    column gets its defects, everything else becomes text (as in a CSV).
    ``key`` defaults to a hash of transaction_id."""
    k = key if key is not None else F.xxhash64("transaction_id")
    rules = {
        "order_date": lambda c: inject_dates(c, k),
        "original_price_inr": lambda c: inject_prices(c, k),
        "customer_rating": lambda c: inject_ratings(c, k),
        "is_prime_member": lambda c: inject_booleans(c, k, "prime"),
        "is_festival_sale": lambda c: inject_booleans(c, k, "festival"),
        "delivery_days": lambda c: inject_delivery(c, k),
        "customer_city": lambda c: inject_aliases(c, k, CITY_VARIANTS, "city"),
        "category": lambda c: inject_aliases(c, k, CATEGORY_VARIANTS, "category"),
        "payment_method": lambda c: inject_aliases(c, k, PAYMENT_VARIANTS, "payment"),
    }
    return df.select(*[(rules[c](F.col(c)) if c in rules else F.col(c).cast("string")).alias(c)
                       for c in df.columns])


def _pick(values: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def messy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dirty row per order (the raw text every cleaner parses)."""
    from bazaar.sources.scratch import spread
    from bazaar.sources.tables import table
    o = spread(table(spark, sf_dir, "orders"))
    k = F.col("o_orderkey")
    prod = F.col("o_custkey") % 200
    city = _pick(CITIES, F.col("o_custkey") % len(CITIES))
    category = _pick(CATEGORIES, prod % len(CATEGORIES))
    payment = _pick(PAYMENT_METHODS, k % len(PAYMENT_METHODS))
    return o.select(
        k.alias("seq"),
        F.concat(F.lit("T"), k.cast("string")).alias("transaction_id"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("customer_id"),
        F.concat(F.lit("P"), prod.cast("string")).alias("product_id"),
        inject_dates(F.col("o_orderdate").cast("date"), k).alias("order_date"),
        inject_prices(F.col("o_totalprice"), k).alias("original_price_inr"),
        F.when(hash100(k, "amount") >= 2, F.col("o_totalprice")).alias("final_amount_inr"),
        inject_ratings(true_rating(k), k).alias("customer_rating"),
        inject_aliases(city, k, CITY_VARIANTS, "city").alias("customer_city"),
        inject_aliases(category, k, CATEGORY_VARIANTS, "category").alias("category"),
        inject_aliases(payment, k, PAYMENT_VARIANTS, "payment").alias("payment_method"),
        inject_booleans(F.col("o_custkey") % 3 == 0, k, "prime").alias("is_prime_member"),
        inject_booleans(F.month("o_orderdate").isin(10, 11), k, "festival").alias("is_festival_sale"),
        inject_delivery(1 + hash100(k, "delivery_aux") % 9, k).alias("delivery_days"),
    )


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``messy`` plus 3 % duplicated rows, as the yearly raw files carry."""
    return inject_duplicates(messy(spark, sf_dir), "seq")


# --------------------------------------------------------------------------- #
# Oracle text of the same views (DuckDB)
# --------------------------------------------------------------------------- #
def _sql_pick(values: list[str], idx: str) -> str:
    arr = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"([{arr}])[({idx}) + 1]"


def _sql_aliases(canonical: str, key: str, variants: dict[str, list[str]], salt: str,
                 rate: int = 45, case_noise: int = 10) -> str:
    h = _sql_hash(key, salt)
    parts = []
    for canon, vs in variants.items():
        parts.append(f"when {canonical} = '{canon}' and {h} < {rate} then "
                     f"{_sql_pick(vs, f'({key}) % {len(vs)}')}")
    known = ", ".join(f"'{c}'" for c in variants)
    parts.append(f"when {canonical} not in ({known}) and {h} < {case_noise} then upper({canonical})")
    return "case " + " ".join(parts) + f" else {canonical} end"


def _sql_bool(flag: str, key: str, salt: str) -> str:
    h = _sql_hash(key, salt)
    return (f"case when {h} % 5 = 1 then (case when {flag} then 'Yes' else 'No' end) "
            f"when {h} % 5 = 2 then (case when {flag} then '1' else '0' end) "
            f"when {h} % 5 = 3 then (case when {flag} then 'Y' else 'N' end) "
            f"when {h} % 5 = 4 and floor({h} / 5) % 10 < 3 then null "
            f"else (case when {flag} then 'True' else 'False' end) end")


def _messy_sql() -> str:
    k = "o_orderkey"
    hd, hp, hr = _sql_hash(k, "date"), _sql_hash(k, "price"), _sql_hash(k, "rating")
    hv, aux = _sql_hash(k, "delivery"), _sql_hash(k, "delivery_aux")
    d = "cast(o_orderdate as date)"
    whole = "cast(floor(o_totalprice) as bigint)"
    rating = f"(1.0 + ({_sql_hash(k, 'rating_value')} % 9) * 0.5)"
    r_whole = f"cast(cast(round_even({rating}, 0) as int) as varchar)"
    city = _sql_pick(CITIES, f"o_custkey % {len(CITIES)}")
    category = _sql_pick(CATEGORIES, f"(o_custkey % 200) % {len(CATEGORIES)}")
    payment = _sql_pick(PAYMENT_METHODS, f"{k} % {len(PAYMENT_METHODS)}")
    return f"""
select {k} as seq, concat('T', cast({k} as varchar)) as transaction_id,
  concat('C', cast(o_custkey as varchar)) as customer_id,
  concat('P', cast(o_custkey % 200 as varchar)) as product_id,
  case when {hd} < 30 then strftime({d}, '%d/%m/%Y') when {hd} < 55 then strftime({d}, '%d-%m-%y')
       when {hd} < 85 then strftime({d}, '%Y-%m-%d') when {hd} < 93 then strftime({d}, '%m/%d/%Y')
       when {hd} < 95 then '32/13/2020' when {hd} < 97 then '00/00/0000'
       when {hd} < 99 then 'not available' else '' end as order_date,
  case when {hp} < 35 then concat('₹', format('{{:,}}', {whole}))
       when {hp} < 50 then format('{{:,.2f}}', o_totalprice)
       when {hp} < 58 then 'Price on Request'
       when {hp} < 63 then cast({whole} * 100 as varchar)
       else format('{{:.2f}}', o_totalprice) end as original_price_inr,
  case when {_sql_hash(k, 'amount')} >= 2 then o_totalprice end as final_amount_inr,
  case when {hr} < 20 then null when {hr} < 40 then concat({r_whole}, ' stars')
       when {hr} < 55 then concat({r_whole}, '/5')
       when {hr} < 70 then concat(cast({rating} as double)::varchar, '/5.0')
       else cast({rating} as double)::varchar end as customer_rating,
  {_sql_aliases(city, k, CITY_VARIANTS, 'city')} as customer_city,
  {_sql_aliases(category, k, CATEGORY_VARIANTS, 'category')} as category,
  {_sql_aliases(payment, k, PAYMENT_VARIANTS, 'payment')} as payment_method,
  {_sql_bool('(o_custkey % 3 = 0)', k, 'prime')} as is_prime_member,
  {_sql_bool('(month(o_orderdate) in (10, 11))', k, 'festival')} as is_festival_sale,
  case when {hv} < 70 then cast(1 + {aux} % 9 as varchar) when {hv} < 80 then 'Same Day'
       when {hv} < 88 then concat(cast(1 + {aux} % 3 as varchar), '-', cast(4 + {aux} % 3 as varchar), ' days')
       when {hv} < 94 then concat('-', cast(1 + {aux} % 3 as varchar))
       when {aux} % 3 = 0 then '50' when {aux} % 3 = 1 then '99' end as delivery_days
from orders"""


MESSY_SQL = _messy_sql()
RAW_SQL = f"""
select *, 0 as _copy from messy
union all
select *, 1 as _copy from messy where {_sql_hash('seq', 'dup')} < 3"""
