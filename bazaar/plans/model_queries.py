"""Star-schema queries: dimensions, key checks, enrichment, the fact view."""

from __future__ import annotations

from pyspark.sql import functions as F

from bazaar.operators import clean as C
from bazaar.operators import dims as D
from bazaar.operators import inject as G
from bazaar.plans import sqltext as S
from bazaar.plans.registry import register
from bazaar.schema import CITY_CANONICAL, CITY_TIERS
from bazaar.sources.scratch import materialize
from bazaar.sources.tables import sales

register("sales", rounding={"final_amount_inr": 4, "discount_percent": 6, "delivery_charges": 6},
         oracle="select * from sales")(lambda s, d: sales(s, d))

register("product_dim", oracle="""
select product_id, arg_min(product_name, transaction_id) as product_name,
       arg_min(category, transaction_id) as category, arg_min(subcategory, transaction_id) as subcategory,
       arg_min(brand, transaction_id) as brand, arg_min(product_rating, transaction_id) as product_rating
from sales group by product_id""")(lambda s, d: D.product_dim(sales(s, d)))

register("customer_dim", rounding={"total_spend": 4}, oracle="""
select customer_id,
       arg_min(customer_city, transaction_id) filter (where customer_city is not null) as customer_city,
       arg_min(customer_state, transaction_id) filter (where customer_state is not null) as customer_state,
       arg_min(customer_tier, transaction_id) filter (where customer_tier is not null) as customer_tier,
       arg_min(age_group, transaction_id) filter (where age_group is not null) as age_group,
       bool_or(is_prime_member) as is_prime_member, count(transaction_id) as total_orders,
       coalesce(fsum(final_amount_inr), 0) as total_spend
from sales where customer_id is not null group by customer_id""")(
    lambda s, d: D.customer_dim(sales(s, d)))

register("time_dim", oracle="""
select order_date, cast(year(order_date) as int) as year, cast(quarter(order_date) as int) as quarter,
       cast(month(order_date) as int) as month, monthname(order_date) as month_name,
       dayname(order_date) as day_of_week
from (select distinct order_date from sales where order_date is not null) t""")(
    lambda s, d: D.time_dim(sales(s, d)))


def _warehouse(s, d):
    """The fact's keys, written once for the checks of all tables, and the dimensions built from them: a
    key check reads nothing else."""
    fact = materialize(sales(s, d).select("transaction_id", "product_id", "customer_id", "order_date"), "keys", codec="zstd")
    return {"transactions": fact, **D.build_dimensions(fact)}


register("pk_violations", oracle="""
with k as (select 'transactions' as table_name, 'transaction_id' as key_columns,
                  transaction_id is null as nk, count(*) as n from sales group by transaction_id),
     p as (select 'products' as table_name, 'product_id' as key_columns, product_id is null as nk,
                  1 as n from sales group by product_id),
     c as (select 'customers' as table_name, 'customer_id' as key_columns, customer_id is null as nk,
                  1 as n from sales where customer_id is not null group by customer_id),
     t as (select 'time_dimension' as table_name, 'order_date' as key_columns, order_date is null as nk,
                  1 as n from sales where order_date is not null group by order_date),
     a as (select * from k union all select * from p union all select * from c union all select * from t)
select table_name, key_columns,
       coalesce(sum(case when nk then n end), 0) as null_keys,
       coalesce(sum(case when not nk and n > 1 then n - 1 end), 0) as duplicate_rows,
       count(*) as distinct_keys
from a group by table_name, key_columns""")(lambda s, d: D.pk_violations(_warehouse(s, d)))

# The dimensions are those of the orders before 1996, so later newcomers are orphans.
register("fk_violations", oracle="""
with early as (select distinct product_id, customer_id from sales where order_year < 1996)
select 'product_id' as fk_column, 'products' as ref_table, count(*) as orphan_rows
from sales s where product_id is not null
  and not exists (select 1 from early e where e.product_id = s.product_id)
union all
select 'customer_id', 'customers', count(*)
from sales s where customer_id is not null
  and not exists (select 1 from early e where e.customer_id = s.customer_id)""")(
    lambda s, d: D.fk_violations(sales(s, d), D.build_dimensions(sales(s, d).where("order_year < 1996"))))

_CITY_VALUES = ", ".join(f"({S.q(c)}, {S.q(st)}, {S.q(t)})" for c, (st, t) in CITY_TIERS.items())

register("enrich_city", ctes=("messy",), oracle=f"""
select m.seq, m.customer_city, l.city_state, l.city_tier
from (select seq, {S.lookup('customer_city', CITY_CANONICAL)} as customer_city from messy) m
left join (values {_CITY_VALUES}) l(customer_city, city_state, city_tier)
  on l.customer_city = m.customer_city""")(
    lambda s, d: D.enrich_city(C.clean_cities(G.messy(s, d)).select("seq", "customer_city")))
