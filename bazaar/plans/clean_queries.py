"""Cleaning, defect-injection and audit queries over the ``messy`` / ``raw``
views (orders dirtied reproducibly), each with its oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from bazaar.operators import clean as C
from bazaar.operators import inject as G
from bazaar.plans import sqltext as S
from bazaar.plans.registry import register
from bazaar.schema import CATEGORY_CANONICAL, CITY_CANONICAL, PAYMENT_CANONICAL
from bazaar.sources.files import union_years
from bazaar.sources.tables import sales

# The driver's orders span 1995-2001, so the date window is moved there.
WINDOW = ("1995-01-01", "2001-12-31")
RAW_ORDER = ["_copy", "seq"]
M = ("messy",)
RAW = ("raw",)


def _messy(spark, d):
    return G.messy(spark, d)


# --------------------------------------------------------------------------- #
# Injected views
# --------------------------------------------------------------------------- #
register("inject_dates", ctes=M, oracle="select seq, order_date from messy")(
    lambda s, d: _messy(s, d).select("seq", "order_date"))
register("inject_prices", ctes=M, oracle="select seq, original_price_inr from messy")(
    lambda s, d: _messy(s, d).select("seq", "original_price_inr"))
register("inject_ratings", ctes=M, oracle="select seq, customer_rating from messy")(
    lambda s, d: _messy(s, d).select("seq", "customer_rating"))
register("inject_booleans", ctes=M, oracle="select seq, is_prime_member, is_festival_sale from messy")(
    lambda s, d: _messy(s, d).select("seq", "is_prime_member", "is_festival_sale"))
register("inject_delivery", ctes=M, oracle="select seq, delivery_days from messy")(
    lambda s, d: _messy(s, d).select("seq", "delivery_days"))
register("inject_aliases", ctes=M,
         oracle="select seq, customer_city, category, payment_method from messy")(
    lambda s, d: _messy(s, d).select("seq", "customer_city", "category", "payment_method"))
register("inject_duplicates", ctes=RAW, oracle="select seq, _copy, transaction_id from raw")(
    lambda s, d: G.raw(s, d).select("seq", "_copy", "transaction_id"))
def _two_files(spark, d):
    """IO2/U1: the raw view as two frames, the copies with their columns in reverse
    order and without delivery_days."""
    raw = G.raw(spark, d)
    copies = raw.where("_copy = 1").select(*[c for c in reversed(raw.columns) if c != "delivery_days"])
    return union_years([raw.where("_copy = 0"), copies])


register("union_years", ctes=RAW, oracle="""
select * replace (case when _copy = 0 then delivery_days end as delivery_days) from raw""")(_two_files)

# --------------------------------------------------------------------------- #
# CL1-CL11, one step at a time on the messy view
# --------------------------------------------------------------------------- #
_D = S.parse_date("order_date", *WINDOW)

register("clean_dates", ctes=M, oracle=f"""
select seq, order_date, cast(year(order_date) as int) as order_year,
       cast(month(order_date) as int) as order_month, cast(quarter(order_date) as int) as order_quarter
from (select seq, {_D} as order_date from messy) t""")(
    lambda s, d: C.clean_dates(_messy(s, d), window=WINDOW)
    .select("seq", "order_date", "order_year", "order_month", "order_quarter"))

register("clean_prices", ctes=M, oracle=f"""
select seq, {S.parse_price('original_price_inr')} as original_price_inr from messy""")(
    lambda s, d: C.clean_prices(_messy(s, d)).select("seq", "original_price_inr"))

register("clean_ratings", ctes=M, oracle=f"""
select seq, {S.parse_rating('customer_rating')} as customer_rating from messy""")(
    lambda s, d: C.clean_ratings(_messy(s, d)).select("seq", "customer_rating"))

_IMPUTE_RATINGS = f"""
with r as (select seq, product_id, {S.parse_rating('customer_rating')} as customer_rating from messy),
     pm as (select product_id, median(customer_rating) as pm from r
            where product_id is not null group by product_id),
     f as (select r.seq, r.product_id, coalesce(r.customer_rating, pm.pm) as customer_rating
           from r left join pm on r.product_id = pm.product_id)
select seq, product_id, coalesce(customer_rating, (select median(customer_rating) from f)) as customer_rating
from f"""

register("impute_ratings", ctes=M, rounding={"customer_rating": 6}, oracle=_IMPUTE_RATINGS)(
    lambda s, d: C.impute_ratings(C.clean_ratings(_messy(s, d)))
    .select("seq", "product_id", "customer_rating"))

register("clean_cities", ctes=M, oracle=f"""
select seq, {S.lookup('customer_city', CITY_CANONICAL)} as customer_city from messy""")(
    lambda s, d: C.clean_cities(_messy(s, d)).select("seq", "customer_city"))

register("clean_booleans", ctes=M, oracle=f"""
select seq, {S.to_bool('is_prime_member')} as is_prime_member,
       {S.to_bool('is_festival_sale')} as is_festival_sale from messy""")(
    lambda s, d: C.clean_booleans(_messy(s, d)).select("seq", "is_prime_member", "is_festival_sale"))

register("clean_categories", ctes=M, oracle=f"""
select seq, {S.lookup('category', CATEGORY_CANONICAL)} as category from messy""")(
    lambda s, d: C.clean_categories(_messy(s, d)).select("seq", "category"))

register("clean_delivery_days", ctes=M, rounding={"delivery_days": 6}, oracle=f"""
select seq, {S.parse_delivery('delivery_days')} as delivery_days from messy""")(
    lambda s, d: C.clean_delivery_days(_messy(s, d)).select("seq", "delivery_days"))

register("impute_delivery_days", ctes=M, rounding={"delivery_days": 6}, oracle=f"""
with t as (select seq, {S.parse_delivery('delivery_days')} as delivery_days from messy)
select seq, coalesce(delivery_days, (select median(delivery_days) from t)) as delivery_days from t""")(
    lambda s, d: C.impute_delivery_days(C.clean_delivery_days(_messy(s, d)))
    .select("seq", "delivery_days"))

register("clean_payments", ctes=M, oracle=f"""
select seq, {S.lookup('payment_method', PAYMENT_CANONICAL, 'Unknown')} as payment_method from messy""")(
    lambda s, d: C.clean_payments(_messy(s, d)).select("seq", "payment_method"))

_OUTLIERS = f"""
with p as (select seq, {S.parse_price('original_price_inr')} as original_price_inr,
                  {S.lookup('category', CATEGORY_CANONICAL)} as category from messy),
     m as (select category, median(original_price_inr) as m from p
           where category is not null and original_price_inr is not null group by category)
select p.seq, p.category,
       case when m.m is not null and m.m > 0 and p.original_price_inr > m.m * 50
            then p.original_price_inr / 100 else p.original_price_inr end as original_price_inr
from p left join m on p.category = m.category"""

register("fix_price_outliers", ctes=M, rounding={"original_price_inr": 6}, oracle=_OUTLIERS)(
    lambda s, d: C.fix_price_outliers(C.clean_categories(C.clean_prices(_messy(s, d))))
    .select("seq", "category", "original_price_inr"))

register("drop_invalid", ctes=M, oracle=f"""
select seq, order_date, final_amount_inr
from (select seq, {_D} as order_date, final_amount_inr from messy) t
where order_date is not null and final_amount_inr is not null""")(
    lambda s, d: C.drop_invalid(C.clean_dates(_messy(s, d), window=WINDOW))
    .select("seq", "order_date", "final_amount_inr"))

# CL8 on the sales fact, where (order, line) pairs repeat with different
# content: keep the first row in the order of all other columns.
_SALES_COLS = [f.name for f in sales.__globals__["CLEAN_SCHEMA"].fields]
_ORDER = ", ".join(f"{c} nulls first" for c in _SALES_COLS if c != "transaction_id")

register("dedup_keep_first", oracle=f"""
select * exclude (_rn) from (
  select *, row_number() over (partition by transaction_id order by {_ORDER}) as _rn from sales) t
where _rn = 1""")(lambda s, d: C.dedup_keep_first(sales(s, d), "transaction_id"))

# --------------------------------------------------------------------------- #
# CL13: the whole pipeline on raw (messy + duplicates), and its audit
# --------------------------------------------------------------------------- #
_PIPE = f"""
c1 as (select * replace ({_D} as order_date) from raw),
c2 as (select * replace ({S.parse_price('original_price_inr')} as original_price_inr,
                         {S.lookup('category', CATEGORY_CANONICAL)} as category),
              cast(year(order_date) as int) as order_year, cast(month(order_date) as int) as order_month,
              cast(quarter(order_date) as int) as order_quarter from c1),
cm as (select category, median(original_price_inr) as m from c2
       where category is not null and original_price_inr is not null group by category),
c3 as (select c2.* exclude (original_price_inr),
              case when cm.m is not null and cm.m > 0 and c2.original_price_inr > cm.m * 50
                   then c2.original_price_inr / 100 else c2.original_price_inr end as original_price_inr
       from c2 left join cm on c2.category = cm.category),
c4 as (select * replace ({S.parse_rating('customer_rating')} as customer_rating) from c3),
pm as (select product_id, median(customer_rating) as pm from c4 where product_id is not null group by product_id),
c5 as (select c4.* exclude (customer_rating), coalesce(c4.customer_rating, pm.pm) as customer_rating
       from c4 left join pm on c4.product_id = pm.product_id),
c6 as (select * replace (coalesce(customer_rating, (select median(customer_rating) from c5)) as customer_rating) from c5),
c7 as (select * replace ({S.lookup('customer_city', CITY_CANONICAL)} as customer_city,
                         {S.to_bool('is_prime_member')} as is_prime_member,
                         {S.to_bool('is_festival_sale')} as is_festival_sale,
                         {S.parse_delivery('delivery_days')} as delivery_days) from c6),
c8 as (select * replace (coalesce(delivery_days, (select median(delivery_days) from c7)) as delivery_days,
                         {S.lookup('payment_method', PAYMENT_CANONICAL, 'Unknown')} as payment_method) from c7),
c9 as (select * exclude (_rn) from (select *, row_number() over (partition by transaction_id
                                                             order by _copy, seq) as _rn from c8) t
       where _rn = 1),
c10 as (select * exclude (_copy) from c9 where order_date is not null and final_amount_inr is not null)"""

_PIPE_ROUND = {"original_price_inr": 6, "customer_rating": 6, "delivery_days": 6}


def _pipeline(s, d):
    return C.clean_pipeline(G.raw(s, d), window=WINDOW, order=RAW_ORDER)


# Columns of the cleaned frame (the raw view's, minus the copy marker, plus
# the derived date parts); ``seq`` is the row order and is not counted.
_CLEAN_COLS = ["transaction_id", "customer_id", "product_id", "order_date", "original_price_inr",
               "final_amount_inr", "customer_rating", "customer_city", "category", "payment_method",
               "is_prime_member", "is_festival_sale", "delivery_days", "order_year", "order_month",
               "order_quarter"]
_AVGS = ", ".join(f"avg(cast({c} is null as double)) as n_{c}" for c in _CLEAN_COLS)
_NCOLS = ", ".join(f"n_{c}" for c in _CLEAN_COLS)
_STRUCTS = ", ".join(f"{{'column': '{c}', 'null_pct': n_{c} * 100}}" for c in _CLEAN_COLS)

register("clean_pipeline", ctes=RAW, rounding=_PIPE_ROUND, oracle="with " + _PIPE + """
select * from c10""")(lambda s, d: _pipeline(s, d).clean)

register("cleaning_report", ctes=RAW, oracle="with " + _PIPE + """,
n as (select (select count(*) from raw) as n_raw, (select count(*) from c9) as n_dedup,
             (select count(*) from c10) as n_clean),
z as (select avg(v) * 100 as pct from (select unnest([NCOLS]) as v from (select AVGS from c10) a) u)
select * from (values
  (1, 'duplicates', concat('removed ', cast((select n_raw - n_dedup from n) as varchar), ' duplicate transaction_ids')),
  (2, 'dropped_invalid', concat('removed ', cast((select n_dedup - n_clean from n) as varchar), ' rows missing date/amount')),
  (3, 'rows', concat(format('{:,}', (select n_raw from n)), ' raw -> ', format('{:,}', (select n_clean from n)), ' clean')),
  (4, 'null_pct', concat(format('{:.2f}', (select pct from z)), '% mean null across columns'))
) v(step_order, step, detail)""".replace("NCOLS", _NCOLS).replace("AVGS", _AVGS))(
    lambda s, d: _pipeline(s, d).report)

register("null_pct", ctes=RAW, rounding={"null_pct": 6}, oracle="with " + _PIPE + """
select unnest([STRUCTS], recursive := true) from (select AVGS from c10) a""".replace(
    "STRUCTS", _STRUCTS).replace("AVGS", _AVGS))(
    lambda s, d: C.null_fractions(_pipeline(s, d).clean, exclude=("seq",)))
