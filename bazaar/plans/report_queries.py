"""Report queries over the clean ``sales`` fact, each with its oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from bazaar.functions import format_inr, human_int, money_sum, money_total
from bazaar.operators import reports as R
from bazaar.operators.report_states import FILTER_KEYS, SETS, ReportStates, customer_rollup, report_states
from bazaar.plans.oracle_views import FILTER_CATEGORIES, FILTER_SQL, FILTER_TIERS, FILTER_YEARS
from bazaar.plans.registry import REGISTRY, register
from bazaar.sources.tables import sales

# Amounts carry 4 decimals, so sums rounded to 4 places are tie-free across
# engines; ratios and means are rounded to 6.
M2, M6 = 4, 6


def _on_sales(fn):
    return lambda spark, d: fn(sales(spark, d))


# --------------------------------------------------------------------------- #
# SQL KPIs
# --------------------------------------------------------------------------- #
register("sql_yearly_revenue", rounding={"revenue": M2}, oracle="""
select order_year as year, fsum(final_amount_inr) as revenue, count(*) as orders,
       count(distinct customer_id) as customers
from sales group by order_year""")(lambda s, d: R.run_kpi(sales(s, d), "yearly_revenue"))

register("sql_category_revenue", rounding={"revenue": M2}, oracle="""
select category, fsum(final_amount_inr) as revenue, count(*) as orders
from sales group by category""")(lambda s, d: R.run_kpi(sales(s, d), "category_revenue"))

register("sql_top_cities", rounding={"revenue": M2}, oracle="""
select customer_city as city, fsum(final_amount_inr) as revenue
from sales group by customer_city order by revenue desc, city limit 10""")(
    lambda s, d: R.run_kpi(sales(s, d), "top_cities"))

# --------------------------------------------------------------------------- #
# Revenue and growth
# --------------------------------------------------------------------------- #
_YEARLY = """(select order_year, coalesce(fsum(final_amount_inr), 0) as revenue
              from sales where order_year is not null group by order_year)"""

register("revenue_by_year", rounding={"revenue": M2}, oracle=f"""
select order_year, revenue from {_YEARLY} y""")(_on_sales(R.revenue_by_year))

register("yoy_growth", rounding={"revenue_cr": M6, "growth_pct": M6}, oracle=f"""
select order_year, revenue / 1e7 as revenue_cr,
       (revenue / nullif(lag(revenue) over (order by order_year), 0) - 1) * 100 as growth_pct
from {_YEARLY} y""")(_on_sales(R.yoy_growth))

register("month_year_heatmap", rounding={"revenue_mn": M6}, oracle="""
select order_month, order_year, coalesce(fsum(final_amount_inr), 0) / 1e6 as revenue_mn
from sales where order_month is not null and order_year is not null
group by order_month, order_year""")(_on_sales(R.month_year_heatmap))

register("quarterly_revenue", rounding={"revenue": M2}, oracle="""
select concat(cast(order_year as varchar), '-Q', cast(order_quarter as varchar)) as period,
       order_year, order_quarter, coalesce(fsum(final_amount_inr), 0) as revenue
from sales where order_year is not null and order_quarter is not null
group by order_year, order_quarter""")(_on_sales(R.quarterly_revenue))

register("monthly_seasonality", rounding={"revenue": M2}, oracle="""
select order_month, coalesce(fsum(final_amount_inr), 0) as revenue
from sales where order_month is not null group by order_month""")(_on_sales(R.monthly_seasonality))

register("orders_by_year", oracle="""
select order_year, count(transaction_id) as orders
from sales where order_year is not null group by order_year""")(_on_sales(R.orders_by_year))

register("active_customers", oracle="""
select order_year, count(distinct customer_id) as customers
from sales where order_year is not null group by order_year""")(_on_sales(R.active_customers))

register("business_health", rounding={"revenue_cr": M6, "aov": M6, "return_rate_pct": M6}, oracle="""
select order_year, coalesce(fsum(final_amount_inr), 0) / 1e7 as revenue_cr,
       count(distinct customer_id) as active_customers, (fsum(final_amount_inr) / count(final_amount_inr)) as aov,
       avg(coalesce(cast(return_status = 'Returned' as double), 0.0)) * 100 as return_rate_pct
from sales where order_year is not null group by order_year""")(_on_sales(R.business_health))

_INR = """case when {x} >= 1e7 then concat('₹', format('{{:.2f}}', {x} / 1e7), ' Cr')
              when {x} >= 1e5 then concat('₹', format('{{:.2f}}', {x} / 1e5), ' L')
              else concat('₹', format('{{:,.0f}}', {x})) end"""

register("headline_metrics", rounding={"total_revenue": M2, "yoy_growth_pct": M6, "aov": M6},
         oracle=f"""
with y as (select order_year, revenue,
                  (revenue / nullif(lag(revenue) over (order by order_year), 0) - 1) * 100 as g
           from {_YEARLY} t),
     g as (select case when count(*) > 1 then max_by(g, order_year) else 0.0 end as g from y),
     t as (select coalesce(fsum(final_amount_inr), 0) as total_revenue,
                  count(distinct customer_id) as active_customers,
                  (fsum(final_amount_inr) / count(final_amount_inr)) as aov, count(*) as total_orders from sales)
select total_revenue, g.g as yoy_growth_pct, active_customers, aov, total_orders,
       {_INR.format(x='total_revenue')} as total_revenue_label,
       {_INR.format(x='aov')} as aov_label
from t, g""")(_on_sales(R.headline_metrics))

register("revenue_forecast", rounding={"forecast_final_amount_inr": M2}, oracle=f"""
with y as (select order_year, revenue as final_amount_inr from {_YEARLY} t),
     f as (select regr_slope(final_amount_inr, order_year) as slope,
                  regr_intercept(final_amount_inr, order_year) as intercept,
                  count(final_amount_inr) as n, max(order_year) as mx from y)
select cast(mx + k as int) as order_year, intercept + slope * (mx + k) as forecast_final_amount_inr
from f, range(1, 4) r(k) where n >= 3""")(_on_sales(R.revenue_forecast))

register("format_inr", rounding={"revenue": M2}, oracle=f"""
select category, revenue, {_INR.format(x='revenue')} as revenue_label
from (select category, coalesce(fsum(final_amount_inr), 0) as revenue
      from sales where category is not null group by category) c""")(
    lambda s, d: R.category_revenue(sales(s, d)).withColumn("revenue_label", format_inr("revenue")))

_SHORT = """case when abs({x}) >= 1e7 then concat(format('{{:.2f}}', {x} / 1e7), ' Cr')
                when abs({x}) >= 1e5 then concat(format('{{:.2f}}', {x} / 1e5), ' L')
                when abs({x}) >= 1e3 then concat(format('{{:.1f}}', {x} / 1e3), ' K')
                else format('{{:.0f}}', {x}) end"""

register("human_int", rounding={"revenue": M2}, oracle=f"""
select brand, revenue, orders, {_SHORT.format(x='(-revenue)')} as loss_label, {_SHORT.format(x='orders::double')} as orders_label
from (select brand, coalesce(fsum(final_amount_inr), 0) as revenue, count(transaction_id) as orders
      from sales where brand is not null group by brand) b""")(
    lambda s, d: sales(s, d).where("brand is not null").groupBy("brand")
    .agg(money_sum("final_amount_inr").alias("revenue"), F.count("transaction_id").alias("orders"))
    .withColumn("loss_label", human_int(-F.col("revenue"))).withColumn("orders_label", human_int("orders")))

# --------------------------------------------------------------------------- #
# Customers
# --------------------------------------------------------------------------- #
register("rfm", rounding={"monetary": M2, "log_monetary": M6}, oracle="""
select customer_id,
       cast(date_diff('day', max(order_date), (select max(order_date) from sales) + interval 1 day) as int) as recency,
       count(transaction_id) as frequency, coalesce(fsum(final_amount_inr), 0) as monetary,
       ln(1 + coalesce(fsum(final_amount_inr), 0)) as log_monetary
from sales where customer_id is not null group by customer_id""")(_on_sales(R.rfm))

register("prime_impact", rounding={"aov": M6}, oracle="""
select is_prime_member, (fsum(final_amount_inr) / count(final_amount_inr)) as aov, count(transaction_id) as orders
from sales where is_prime_member is not null group by is_prime_member""")(_on_sales(R.prime_impact))

register("aov_prime", rounding={"aov": M6}, oracle="""
select case when is_prime_member then 'Prime' else 'Non-Prime' end as label, (fsum(final_amount_inr) / count(final_amount_inr)) as aov
from sales where is_prime_member is not null group by is_prime_member""")(_on_sales(R.aov_prime))

register("aov_festival", rounding={"aov": M6}, oracle="""
select case when is_festival_sale then 'Festival' else 'Regular' end as label, (fsum(final_amount_inr) / count(final_amount_inr)) as aov
from sales where is_festival_sale is not null group by is_festival_sale""")(_on_sales(R.aov_festival))

register("age_spend", rounding={"revenue": M2}, oracle="""
select age_group, coalesce(fsum(final_amount_inr), 0) as revenue
from sales where age_group is not null group by age_group""")(_on_sales(R.age_spend))

register("spending_tier_revenue", rounding={"revenue": M2}, oracle="""
select customer_spending_tier, coalesce(fsum(final_amount_inr), 0) as revenue
from sales where customer_spending_tier is not null group by customer_spending_tier""")(
    _on_sales(R.spending_tier_revenue))

_PER_CUSTOMER = """(select customer_id, count(transaction_id) as orders
                    from sales where customer_id is not null group by customer_id)"""

register("purchase_frequency", oracle=f"""
select cast(b as double) as bin_lo, cast(b + 1 as double) as bin_hi,
       count(c.orders) as count
from range(1, 19) r(b) left join {_PER_CUSTOMER} c
  on c.orders >= b and (c.orders < b + 1 or (b = 18 and c.orders = 19))
group by b""")(_on_sales(R.purchase_frequency))

_HIST = """
with v as (select cast({col} as double) as x from {src} where {col} is not null),
     mm as (select case when min(x) = max(x) then min(x) - 0.5 else min(x) end as lo,
                   case when min(x) = max(x) then max(x) + 0.5 else max(x) end as hi from v),
     c as (select least(cast(floor((x - lo) * ({bins}.0 / (hi - lo))) as int), {bins} - 1) as bin,
                  count(*) as n from v, mm where x >= lo and x <= hi group by 1)
select cast(b as int) as bin, lo + b * ((hi - lo) / {bins}) as bin_lo,
       lo + (b + 1) * ((hi - lo) / {bins}) as bin_hi, coalesce(c.n, 0) as count
from range(0, {bins}) r(b) cross join mm left join c on c.bin = b"""

register("purchase_frequency_20", rounding={"bin_lo": M6, "bin_hi": M6},
         oracle=_HIST.format(col="orders", src=_PER_CUSTOMER + " pc", bins=20))(
    _on_sales(R.purchase_frequency_20))

_COHORTS = """(select f.cohort, s.order_year, count(distinct s.customer_id) as customers
   from sales s left join (select customer_id, min(order_year) as cohort from sales
                           where customer_id is not null group by customer_id) f
     on s.customer_id = f.customer_id
   where f.cohort is not null and s.order_year is not null
   group by f.cohort, s.order_year)"""

register("cohort_counts", oracle=f"select * from {_COHORTS} c")(_on_sales(R.cohort_counts))

register("cohort_retention", rounding={"retention": M6}, oracle=f"""
select c.cohort, c.order_year, c.customers, c.customers / b.customers as retention
from {_COHORTS} c left join {_COHORTS} b on b.cohort = c.cohort and b.order_year = b.cohort""")(
    _on_sales(R.cohort_retention))

register("cohort_retention_first_year_base", rounding={"retention": M6}, oracle=f"""
select c.cohort, c.order_year, c.customers, c.customers / b.customers as retention
from {_COHORTS} c left join {_COHORTS} b
  on b.cohort = c.cohort and b.order_year = (select min(order_year) from {_COHORTS} m)""")(
    _on_sales(R.cohort_retention_first_year_base))

# --------------------------------------------------------------------------- #
# Categories, products, brands, geography
# --------------------------------------------------------------------------- #
def _sum_sql(key: str) -> str:
    return f"""select {key}, coalesce(fsum(final_amount_inr), 0) as revenue
from sales where {key} is not null group by {key}"""


def _top_sql(key: str, n: int) -> str:
    return _sum_sql(key) + f" order by revenue desc, {key} limit {n}"


register("category_revenue", rounding={"revenue": M2}, oracle=_sum_sql("category"))(
    _on_sales(R.category_revenue))
register("tier_revenue", rounding={"revenue": M2}, oracle=_sum_sql("customer_tier"))(
    _on_sales(R.tier_revenue))
register("top_cities", rounding={"revenue": M2}, oracle=_top_sql("customer_city", 10))(
    _on_sales(R.top_cities))
register("top_states", rounding={"revenue": M2}, oracle=_top_sql("customer_state", 12))(
    _on_sales(R.top_states))
register("top_brands", rounding={"revenue": M2}, oracle=_top_sql("brand", 10))(
    _on_sales(R.top_brands))
register("top_products", rounding={"revenue": M2}, oracle=_top_sql("product_name", 10))(
    _on_sales(R.top_products))

register("category_share", rounding={"revenue": M2, "share_pct": M6}, oracle=f"""
select category, revenue, revenue * 100 / nullif(sum(revenue) over (), 0) as share_pct
from ({_sum_sql('category')}) c""")(_on_sales(R.category_share))

register("category_lifecycle", oracle="""
select order_year, category, count(transaction_id) as orders
from sales where order_year is not null and category is not null
group by order_year, category""")(_on_sales(R.category_lifecycle))

register("age_category_share", rounding={"share": M6}, oracle="""
select age_group, category, revenue / nullif(sum(revenue) over (partition by age_group), 0) as share
from (select age_group, category, coalesce(fsum(final_amount_inr), 0) as revenue
      from sales where age_group is not null and category is not null
      group by age_group, category) c""")(_on_sales(R.age_category_share))

register("brand_share_trend", rounding={"revenue": M2, "share_pct": M6}, oracle="""
select order_year, brand, revenue,
       revenue * 100 / nullif(sum(revenue) over (partition by order_year), 0) as share_pct
from (select order_year, brand, coalesce(fsum(final_amount_inr), 0) as revenue
      from sales where order_year is not null and brand is not null
      group by order_year, brand) c""")(_on_sales(R.brand_share_trend))

register("festival_daily", rounding={"revenue": M2}, oracle="""
select order_date, is_festival_sale, coalesce(fsum(final_amount_inr), 0) as revenue
from sales where order_date is not null and is_festival_sale is not null
group by order_date, is_festival_sale""")(_on_sales(R.festival_daily))

# --------------------------------------------------------------------------- #
# Payments, discounts, returns, ratings, delivery, prices
# --------------------------------------------------------------------------- #
register("payment_mix", rounding={"share_pct": M6}, oracle="""
select payment_method, orders, orders * 100.0 / nullif(sum(orders) over (), 0) as share_pct
from (select payment_method, count(transaction_id) as orders from sales
      where payment_method is not null group by payment_method) p""")(_on_sales(R.payment_mix))

register("payment_evolution", oracle="""
select order_year, payment_method, count(transaction_id) as orders
from sales where order_year is not null and payment_method is not null
group by order_year, payment_method""")(_on_sales(R.payment_evolution))

register("payment_share", rounding={"share_pct": M6}, oracle="""
with c as (select order_year, payment_method, count(transaction_id) as n from sales
           where order_year is not null and payment_method is not null
           group by order_year, payment_method),
     g as (select y.order_year, m.payment_method
           from (select distinct order_year from c) y, (select distinct payment_method from c) m)
select g.order_year, g.payment_method,
       cast(coalesce(c.n, 0) as double) * 100
         / nullif(sum(coalesce(c.n, 0)) over (partition by g.order_year), 0) as share_pct
from g left join c on c.order_year = g.order_year and c.payment_method = g.payment_method""")(
    _on_sales(R.payment_share))

_BAND = """case when discount_percent > -1 and discount_percent <= 0 then '0%'
     when discount_percent > 0 and discount_percent <= 10 then '1-10%'
     when discount_percent > 10 and discount_percent <= 20 then '11-20%'
     when discount_percent > 20 and discount_percent <= 30 then '21-30%'
     when discount_percent > 30 and discount_percent <= 100 then '30%+' end"""

register("discount_bands", rounding={"revenue": M2}, oracle=f"""
with b as (select {_BAND} as band, final_amount_inr, transaction_id from sales),
     a as (select band, coalesce(fsum(final_amount_inr), 0) as revenue,
                  count(transaction_id) as orders from b where band is not null group by band),
     l as (select * from (values ('0%', 0), ('1-10%', 1), ('11-20%', 2), ('21-30%', 3), ('30%+', 4))
           v(band, band_order))
select l.band, cast(l.band_order as int) as band_order, coalesce(a.revenue, 0.0) as revenue,
       coalesce(a.orders, 0) as orders
from l left join a on a.band = l.band""")(_on_sales(R.discount_bands))

register("return_rate_by_category", rounding={"return_rate_pct": M6}, oracle="""
select category, avg(coalesce(cast(return_status = 'Returned' as int), 0)) * 100 as return_rate_pct
from sales where category is not null group by category""")(_on_sales(R.return_rate_by_category))

_BOX = """
with q as (select {key}, count({val}) as n,
                  quantile_cont({val}, 0.25) as q1, quantile_cont({val}, 0.5) as median,
                  quantile_cont({val}, 0.75) as q3
           from sales where {key} is not null and {val} is not null group by {key}),
     f as (select *, q1 - 1.5 * (q3 - q1) as lf, q3 + 1.5 * (q3 - q1) as hf from q)
select f.{key}, f.n, f.q1, f.median, f.q3,
       min(case when s.{val} between lf and hf then s.{val} end) as whisker_lo,
       max(case when s.{val} between lf and hf then s.{val} end) as whisker_hi,
       count(*) filter (where not (s.{val} between lf and hf)) as outliers
from f join sales s on s.{key} = f.{key} and s.{val} is not null
group by f.{key}, f.n, f.q1, f.median, f.q3"""

_BOX_ROUND = {"q1": M6, "median": M6, "q3": M6, "whisker_lo": M6, "whisker_hi": M6}

register("rating_box_by_return", rounding=_BOX_ROUND,
         oracle=_BOX.format(key="return_status", val="customer_rating"))(_on_sales(R.rating_box_by_return))

register("price_box_by_category", rounding=_BOX_ROUND, oracle=f"""
select *, row_number() over (order by median, category) as median_rank from (
{_BOX.format(key="category", val="final_amount_inr")}) b""")(_on_sales(R.price_box_by_category))

register("category_median_price", rounding={"median_price": M6}, oracle="""
select category, quantile_cont(original_price_inr, 0.5) as median_price
from sales where category is not null and original_price_inr is not null group by category""")(
    _on_sales(R.category_median_price))

register("rating_histogram", rounding={"bin_lo": M6, "bin_hi": M6},
         oracle=_HIST.format(col="customer_rating", src="sales", bins=9))(_on_sales(R.rating_histogram))

register("delivery_histogram", rounding={"bin_lo": M6, "bin_hi": M6},
         oracle=_HIST.format(col="delivery_days", src="sales", bins=16))(_on_sales(R.delivery_histogram))

register("aov_by_rating", rounding={"aov": M6}, oracle="""
select round_even(customer_rating, 0) as rating, (fsum(final_amount_inr) / count(final_amount_inr)) as aov
from sales where customer_rating is not null group by 1""")(_on_sales(R.aov_by_rating))

register("delivery_by_tier", rounding={"avg_delivery_days": M6}, oracle="""
select customer_tier, avg(delivery_days) as avg_delivery_days
from sales where customer_tier is not null group by customer_tier""")(_on_sales(R.delivery_by_tier))

_CORR_COLS = R.CORR_COLUMNS


def _corr_sql() -> str:
    parts = []
    for a in _CORR_COLS:
        for b in _CORR_COLS:
            parts.append(f"""select '{a}' as col_a, '{b}' as col_b,
  covar_samp(x, y) / nullif(stddev_samp(x) * stddev_samp(y), 0) as r
from (select case when {a} is not null and {b} is not null then cast({a} as double) end as x,
             case when {a} is not null and {b} is not null then cast({b} as double) end as y from sales) t""")
    return "\nunion all\n".join(parts)


register("correlation_matrix", rounding={"r": M6}, oracle=_corr_sql())(_on_sales(R.correlation_matrix))

register("price_sample", rounding={"final_amount_inr": M6, "discount_percent": M6}, oracle="""
select transaction_id, final_amount_inr, discount_percent from sales
order by md5(concat(transaction_id, '#1')), transaction_id, final_amount_inr, discount_percent
limit 5000""")(_on_sales(R.price_sample))

# --------------------------------------------------------------------------- #
# Dashboard filter
# --------------------------------------------------------------------------- #
register("filter_options", oracle="""
select distinct kind, value from (
  select 'year' as kind, cast(order_year as varchar) as value from sales
  union all select 'category', category from sales
  union all select 'tier', customer_tier from sales) u where value is not null""")(
    _on_sales(R.filter_options))

register("global_filters", rounding={"final_amount_inr": M6}, oracle=f"""
select transaction_id, order_year, category, customer_tier, final_amount_inr from sales
where {FILTER_SQL}""")(
    lambda s, d: R.global_filters(sales(s, d), FILTER_YEARS, FILTER_CATEGORIES, FILTER_TIERS)
    .select("transaction_id", "order_year", "category", "customer_tier", "final_amount_inr"))

# The dashboard over filtered rows: answered from states, checked against the same report over filtered sales.
FILTERED = ["headline_metrics", "revenue_by_year", "category_revenue", "orders_by_year", "active_customers", "quarterly_revenue",
            "aov_festival", "discount_bands", "rfm", "purchase_frequency_20", "cohort_retention", "top_products", "top_brands",
            "rating_histogram", "category_lifecycle", "delivery_by_tier", "payment_evolution", "return_rate_by_category",
            "revenue_forecast", "top_states", "business_health"]


#: Those that count distinct customers, from bitmaps.
_OF_CUSTOMERS = {"headline_metrics", "active_customers", "cohort_retention", "business_health"}


def _filtered(report):
    def build(spark, sf_dir):
        states = ReportStates.build(sales(spark, sf_dir), customers=report.__name__ in _OF_CUSTOMERS)
        return report(R.global_filters(states, FILTER_YEARS, FILTER_CATEGORIES, FILTER_TIERS))
    return build


for _name in FILTERED:
    _q = REGISTRY[_name]
    register(f"filtered_{_name}", oracle=_q.oracle, rounding=_q.rounding, ctes=("filtered sales",))(_filtered(getattr(R, _name)))

# The long table itself: every report set by its keys and the filter keys.
_STATE_COLS = list(dict.fromkeys([*FILTER_KEYS, *(c for keys in SETS.values() for c in keys)]))


def _state_rows(spark, sf_dir):
    states = report_states(sales(spark, sf_dir))
    return states.select("report_set", *_STATE_COLS, "rows", "orders", money_total(F.col("exact"), F.col("odd")).alias("amount"),
                         "priced", "returned", "delivered", "days", "last")


register("report_states", rounding={"amount": M2}, oracle=f"""
select case {" ".join(f"when {' and '.join(f'grouping({c}) = {int(c not in (*FILTER_KEYS, *keys))}' for c in _STATE_COLS)} then '{name}'"
                      for name, keys in SETS.items())} end as report_set, {", ".join(_STATE_COLS)},
       count(*) as rows, count(transaction_id) as orders, fsum(final_amount_inr) as amount, count(final_amount_inr) as priced,
       count(*) filter (where return_status = 'Returned') as returned, count(delivery_days) as delivered,
       sum(delivery_days) as days, max(order_date) as last
from (select *, {_BAND} as band from sales) s
group by grouping sets ({", ".join(f"({', '.join([*FILTER_KEYS, *keys])})" for keys in SETS.values())})""")(_state_rows)

register("customer_rollup", oracle="""
select order_year, category, customer_tier, grouping(order_year) + 2 * grouping(category) + 4 * grouping(customer_tier) as level,
       count(distinct customer_id) as customers
from sales group by cube (order_year, category, customer_tier)""")(lambda s, d: customer_rollup(sales(s, d)))

# A9 wide form: one column per named category, the rest under Other; a missing cell
# stays NULL (as pandas' pivot_table leaves it missing).
_WIDE = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]

register("category_lifecycle_wide", oracle="select order_year, " + ", ".join(
    f"case when count(*) filter (where category {test}) > 0 "
    f"then count(transaction_id) filter (where category {test}) end as \"{name}\""
    for name, test in [*((c, f"= '{c}'") for c in _WIDE),
                       ("Other", "not in (" + ", ".join(f"'{c}'" for c in _WIDE) + ")")])
    + " from sales where order_year is not null and category is not null group by order_year")(
    lambda s, d: R.category_lifecycle_wide(sales(s, d), _WIDE))
