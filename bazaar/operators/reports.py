"""Business reports over the clean fact (EDA questions, dashboard items,
headline metrics, SQL KPIs). Each takes the fact DataFrame and returns a
small aggregated DataFrame; rendering is the caller's. The additive ones take
``ReportStates`` (one scan for all of them, filters included) in its place.

Group-by semantics follow the source application: rows with a NULL group key
are left out (pandas drops them), except in the SQL KPIs, which keep the NULL
group. Scalars (totals, snapshot date, min/max) are scalar subqueries, so the
fact is never joined to itself or moved into one partition; windows run only
on aggregated tables whose size is bounded by the number of groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaar.functions import discount_band, flag_label, format_inr, period_label
from bazaar.operators import stats
from bazaar.operators.report_states import AMOUNT, FACT, STATES, Measures, ReportStates, filter_condition
from bazaar.schema import DISCOUNT_BANDS

Source = DataFrame | ReportStates
CORR_COLUMNS = ["final_amount_inr", "discount_percent", "delivery_days",
                "customer_rating", "product_rating"]


def _nn(df: DataFrame, *cols: str) -> DataFrame:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond)


def _source(df: Source, *cols: str) -> tuple[DataFrame, Measures]:
    """What to group by ``cols``, and the measures over it: the fact, or a set of states."""
    return (df.covering(*cols), STATES) if isinstance(df, ReportStates) else (df, FACT)


def _by(df: Source, keys: list[str], **measures: str) -> DataFrame:
    """(keys, measures by result name) over the rows whose keys are not NULL."""
    frame, known = _source(df, *keys)
    return _nn(frame, *keys).groupBy(*keys).agg(*[known[m]().alias(name) for name, m in measures.items()])


def _sum_by(df: Source, keys: list[str], name: str = "revenue") -> DataFrame:
    return _by(df, keys, **{name: "revenue"})


def _count_by(df: Source, keys: list[str], name: str = "orders") -> DataFrame:
    return _by(df, keys, **{name: "orders"})


def _customers_by(df: Source, keys: list[str], name: str, approx: bool) -> DataFrame:
    if isinstance(df, ReportStates):
        return _nn(df.customers(*keys), *keys).withColumnRenamed("customers", name)
    return _nn(df, *keys).groupBy(*keys).agg(stats.distinct_count("customer_id", approx).alias(name))


def _share_of_total(agg: DataFrame, col: str, name: str, scale: float = 100.0) -> DataFrame:
    total = agg.agg(F.sum(col)).scalar()
    return agg.withColumn(name, F.try_divide(F.col(col) * scale, F.nullif(total, F.lit(0))))


def _top(agg: DataFrame, key: str, col: str, n: int) -> DataFrame:
    # nlargest: NaN dropped, ties keep the first seen (= smallest key)
    return agg.where(F.col(col).isNotNull()).orderBy(F.desc(col), F.asc(key)).limit(n)


# --------------------------------------------------------------------------- #
# Revenue and growth
# --------------------------------------------------------------------------- #
def revenue_by_year(df: Source) -> DataFrame:
    return _sum_by(df, ["order_year"]).orderBy("order_year")


def yoy_growth(df: Source) -> DataFrame:
    """Q1: yearly revenue in crore and the percentage change on the previous
    year present (NULL for the first, and where the previous is 0)."""
    yearly = _sum_by(df, ["order_year"])
    w = Window.orderBy("order_year")  # one row per year: a bounded table
    prev = F.lag("revenue").over(w)
    return yearly.select(
        "order_year", (F.col("revenue") / 1e7).alias("revenue_cr"),
        ((F.try_divide(F.col("revenue"), F.nullif(prev, F.lit(0.0))) - 1) * 100).alias("growth_pct"))


def month_year_heatmap(df: Source) -> DataFrame:
    """Q2: revenue in millions per (month, year) cell, long form."""
    cells = _sum_by(df, ["order_month", "order_year"])
    return cells.select("order_month", "order_year", (F.col("revenue") / 1e6).alias("revenue_mn"))


def quarterly_revenue(df: Source) -> DataFrame:
    """Revenue per 'YYYY-Qn' period."""
    q = _sum_by(df, ["order_year", "order_quarter"])
    return q.select(period_label("order_year", "order_quarter").alias("period"),
                    "order_year", "order_quarter", "revenue")


def monthly_seasonality(df: Source) -> DataFrame:
    return _sum_by(df, ["order_month"])


def orders_by_year(df: Source) -> DataFrame:
    return _count_by(df, ["order_year"])


def active_customers(df: Source, approx: bool = False) -> DataFrame:
    return _customers_by(df, ["order_year"], "customers", approx)


def business_health(df: Source, approx: bool = False) -> DataFrame:
    """Q20 per year: revenue (crore), active customers, AOV, return %. One pass over the fact; over
    states, the years' sums joined with the years' customers."""
    frame, known = _source(df, "order_year")
    aggs = [(known["revenue"]() / 1e7).alias("revenue_cr"), known["aov"]().alias("aov"),
            known["returned_pct"]().alias("return_rate_pct")]
    if not isinstance(df, ReportStates):
        aggs.insert(1, stats.distinct_count("customer_id", approx).alias("active_customers"))
        return _nn(frame, "order_year").groupBy("order_year").agg(*aggs)
    customers = _customers_by(df, ["order_year"], "active_customers", approx)
    return _nn(frame, "order_year").groupBy("order_year").agg(*aggs).join(customers, "order_year", "left").select(
        "order_year", "revenue_cr", F.coalesce("active_customers", F.lit(0)).alias("active_customers"), "aov",
        "return_rate_pct")


def headline_metrics(df: Source, approx: bool = False) -> DataFrame:
    """M1-M5 plus the row count in view: one aggregation pass for the totals
    and one over the (small) yearly table for the last growth rate."""
    frame, known = _source(df)
    customers = df.customers().scalar() if isinstance(df, ReportStates) else stats.distinct_count("customer_id", approx)
    totals = frame.agg(known["revenue"]().alias("total_revenue"),
                       F.coalesce(customers, F.lit(0)).alias("active_customers"),
                       known["aov"]().alias("aov"), known["rows"]().alias("total_orders"))
    g = yoy_growth(df)
    last = g.agg(F.max_by("growth_pct", "order_year").alias("g"),
                 F.count(F.lit(1)).alias("years"))
    growth = last.select(F.when(F.col("years") > 1, F.col("g")).otherwise(F.lit(0.0)).alias("g")).scalar()
    return totals.select(
        "total_revenue", growth.alias("yoy_growth_pct"), "active_customers", "aov", "total_orders",
        format_inr("total_revenue").alias("total_revenue_label"),
        format_inr("aov").alias("aov_label"))


def revenue_forecast(df: Source, horizon: int = 3) -> DataFrame:
    """Straight-line trend of yearly revenue, next ``horizon`` years."""
    yearly = _sum_by(df, ["order_year"], AMOUNT)
    return stats.linear_forecast(yearly, "order_year", AMOUNT, horizon=horizon)


# --------------------------------------------------------------------------- #
# Customers
# --------------------------------------------------------------------------- #
def rfm(df: Source) -> DataFrame:
    """Recency (days from max date + 1), frequency, monetary, log1p."""
    whole, known = _source(df)
    snapshot = F.date_add(whole.agg(known["last"]()).scalar(), 1)
    per = _by(df, ["customer_id"], _last="last", frequency="orders", monetary="revenue")
    return per.select("customer_id", F.datediff(snapshot, F.col("_last")).alias("recency"),
                      "frequency", "monetary", F.log1p("monetary").alias("log_monetary"))


def prime_impact(df: Source) -> DataFrame:
    """Q6: AOV and order count by Prime flag."""
    return _by(df, ["is_prime_member"], aov="aov", orders="orders")


def aov_prime(df: Source) -> DataFrame:
    a = _by(df, ["is_prime_member"], aov="aov")
    return a.select(flag_label("is_prime_member", "Prime", "Non-Prime").alias("label"), "aov")


def aov_festival(df: Source) -> DataFrame:
    a = _by(df, ["is_festival_sale"], aov="aov")
    return a.select(flag_label("is_festival_sale", "Festival", "Regular").alias("label"), "aov")


def age_spend(df: Source) -> DataFrame:
    return _sum_by(df, ["age_group"])


def spending_tier_revenue(df: Source) -> DataFrame:
    """Only when the column exists (empty result otherwise)."""
    if "customer_spending_tier" not in df.columns:
        return df.sparkSession.createDataFrame([], "customer_spending_tier string, revenue double")
    return _sum_by(df, ["customer_spending_tier"])


def orders_per_customer(df: Source) -> DataFrame:
    return _count_by(df, ["customer_id"], "orders")


def purchase_frequency(df: Source, edges: list[float] | None = None) -> DataFrame:
    """Q17: customers per orders-per-customer bin on edges 1..19."""
    edges = edges or list(range(1, 20))
    return stats.fixed_edge_histogram(orders_per_customer(df), "orders", edges)


def purchase_frequency_20(df: Source) -> DataFrame:
    """The same distribution in 20 equal-width bins."""
    return stats.histogram(orders_per_customer(df), "orders", 20)


def cohort_counts(df: Source) -> DataFrame:
    """Q14: distinct customers per (acquisition year, order year).

    One aggregation per customer collects the set of years they ordered in
    (bounded by the calendar, a handful of values, and combined map-side, so
    a customer holding a third of all rows is reduced in every task); the
    cohort is the smallest year of the set. The fact is shuffled once and
    no join is needed."""
    if isinstance(df, ReportStates):
        return df.cohort_counts()
    years = _nn(df, "customer_id", "order_year").groupBy("customer_id") \
        .agg(F.collect_set("order_year").alias("_years"))
    return years.select(F.array_min("_years").alias("cohort"), F.explode("_years").alias("order_year")) \
        .groupBy("cohort", "order_year").agg(F.count(F.lit(1)).alias("customers"))


def _retention(c: DataFrame, base_year: Column) -> DataFrame:
    # windows over the cohort x year table (bounded by years squared)
    base = F.max(F.when(F.col("order_year") == base_year, F.col("customers"))) \
        .over(Window.partitionBy("cohort"))
    return c.select("cohort", "order_year", "customers",
                    F.try_divide(F.col("customers").cast("double"), base.cast("double")).alias("retention"))


def cohort_retention(df: Source) -> DataFrame:
    """Share of a cohort still buying, over the cohort's own first-year size."""
    return _retention(cohort_counts(df), F.col("cohort"))


def cohort_retention_first_year_base(df: Source) -> DataFrame:
    """Parity variant: every cohort divided by its count in the earliest
    calendar year present (so only the earliest cohort gets values)."""
    c = cohort_counts(df)
    first_year = F.min("order_year").over(Window.partitionBy())  # years x years rows
    return _retention(c.withColumn("_first", first_year), F.col("_first"))


# --------------------------------------------------------------------------- #
# Categories, products, brands, geography
# --------------------------------------------------------------------------- #
def category_revenue(df: Source) -> DataFrame:
    return _sum_by(df, ["category"]).orderBy(F.desc("revenue"), "category")


def category_share(df: Source) -> DataFrame:
    """Category revenue and its percentage of the total."""
    return _share_of_total(_sum_by(df, ["category"]), "revenue", "share_pct")


def category_lifecycle(df: Source) -> DataFrame:
    """Orders per (year, category), long form."""
    return _count_by(df, ["order_year", "category"])


def category_lifecycle_wide(df: Source, categories: list[str]) -> DataFrame:
    """Wide variant for display: one column per named category and Other for the rest (the long form
    holds every category). A year without a category's rows has NULL there."""
    cells = _count_by(df, ["order_year", "category"])
    known = F.col("category").isin(*categories)
    return cells.groupBy("order_year").agg(
        *[F.sum(F.when(F.col("category") == c, F.col("orders"))).alias(c) for c in categories],
        F.sum(F.when(~known, F.col("orders"))).alias("Other"))


def age_category_share(df: Source) -> DataFrame:
    """Q9: category share of each age group's spend."""
    cell = _sum_by(df, ["age_group", "category"])
    w = Window.partitionBy("age_group")  # groups x categories rows
    return cell.select("age_group", "category",
                       F.try_divide(F.col("revenue"), F.nullif(F.sum("revenue").over(w), F.lit(0.0)))
                       .alias("share"))


def tier_revenue(df: Source) -> DataFrame:
    return _sum_by(df, ["customer_tier"])


def top_cities(df: Source, n: int = 10) -> DataFrame:
    return _top(_sum_by(df, ["customer_city"]), "customer_city", "revenue", n)


def top_states(df: Source, n: int = 12) -> DataFrame:
    return _top(_sum_by(df, ["customer_state"]), "customer_state", "revenue", n)


def top_brands(df: Source, n: int = 10) -> DataFrame:
    return _top(_sum_by(df, ["brand"]), "brand", "revenue", n)


def top_products(df: Source, n: int = 10) -> DataFrame:
    return _top(_sum_by(df, ["product_name"]), "product_name", "revenue", n)


def brand_share_trend(df: Source) -> DataFrame:
    """Each brand's share of its year's revenue (the stated intent of Q13)."""
    cell = _sum_by(df, ["order_year", "brand"])
    w = Window.partitionBy("order_year")
    return cell.select("order_year", "brand", "revenue",
                       F.try_divide(F.col("revenue") * 100, F.nullif(F.sum("revenue").over(w), F.lit(0.0)))
                       .alias("share_pct"))


def festival_daily(df: Source) -> DataFrame:
    """Q8: daily revenue split by festival flag."""
    return _sum_by(df, ["order_date", "is_festival_sale"])


# --------------------------------------------------------------------------- #
# Payments, discounts, returns, ratings, delivery, prices
# --------------------------------------------------------------------------- #
def payment_mix(df: Source) -> DataFrame:
    """Orders per payment method and the share of all orders."""
    return _share_of_total(_count_by(df, ["payment_method"]), "orders", "share_pct")


def payment_evolution(df: Source) -> DataFrame:
    """Orders per (year, method), observed cells only."""
    return _count_by(df, ["order_year", "payment_method"])


def payment_share(df: Source) -> DataFrame:
    """Q4: each method's share of the year's orders, zero-filled on the grid
    of observed years x observed methods (the categorical behaviour).

    The grid keeps the unbounded side distributed: every observed method is
    one row, and the observed years (bounded by the calendar) come as one
    small array from a scalar subquery and are exploded per method. No pivot
    (whose value list is capped) and no cross join."""
    counts = _count_by(df, ["order_year", "payment_method"], "n")
    years = counts.agg(F.array_sort(F.collect_set("order_year"))).scalar()
    grid = counts.select("payment_method").distinct() \
        .select("payment_method", F.explode(years).alias("order_year"))
    long = grid.join(counts, ["order_year", "payment_method"], "left") \
        .select("order_year", "payment_method", F.coalesce(F.col("n"), F.lit(0)).alias("n"))
    w = Window.partitionBy("order_year")
    return long.select("order_year", "payment_method",
                       F.try_divide(F.col("n").cast("double") * 100,
                                    F.nullif(F.sum("n").over(w), F.lit(0)).cast("double"))
                       .alias("share_pct"))


def discount_bands(df: Source) -> DataFrame:
    """Revenue and orders per discount band; all five bands present."""
    if not isinstance(df, ReportStates):
        df = df.select(discount_band("discount_percent").alias("band"), AMOUNT, "transaction_id")
    agg = _by(df, ["band"], revenue="revenue", orders="orders")
    labels = df.sparkSession.createDataFrame(
        [(i, label) for i, (_, _, label) in enumerate(DISCOUNT_BANDS)], "band_order int, band string")
    return labels.join(agg, "band", "left").select(
        "band", "band_order", F.coalesce("revenue", F.lit(0.0)).alias("revenue"),
        F.coalesce("orders", F.lit(0)).cast("long").alias("orders"))


def return_rate_by_category(df: Source) -> DataFrame:
    """Percentage of returned orders per category."""
    return _by(df, ["category"], return_rate_pct="returned_pct")


def rating_box_by_return(df: DataFrame) -> DataFrame:
    return stats.box_summary(df, ["return_status"], "customer_rating", few_values=True)


def _value_histogram(df: Source, value: str, bins: int) -> DataFrame:
    if isinstance(df, ReportStates):
        return stats.histogram(df.covering(value), value, bins, weight="rows")
    return stats.histogram(df, value, bins)


def rating_histogram(df: Source, bins: int = 9) -> DataFrame:
    return _value_histogram(df, "customer_rating", bins)


def aov_by_rating(df: Source) -> DataFrame:
    """Q16: mean order value by rating rounded half-even to a whole star."""
    frame, known = _source(df, "customer_rating")
    r = F.bround("customer_rating", 0)
    return frame.where(r.isNotNull()).groupBy(r.alias("rating")).agg(known["aov"]().alias("aov"))


def delivery_histogram(df: Source, bins: int = 16) -> DataFrame:
    return _value_histogram(df, "delivery_days", bins)


def delivery_by_tier(df: Source) -> DataFrame:
    return _by(df, ["customer_tier"], avg_delivery_days="avg_delivery_days")


def price_box_by_category(df: DataFrame) -> DataFrame:
    """Box numbers of the order amount per category, ranked by
    median (1 = cheapest)."""
    box = stats.box_summary(df, ["category"], AMOUNT)
    w = Window.orderBy("median", "category")  # one row per category
    return box.withColumn("median_rank", F.row_number().over(w))


def category_median_price(df: DataFrame, price_col: str = "original_price_inr",
                          approx: bool = False) -> DataFrame:
    return stats.median_by(df, ["category"], price_col, "median_price", approx=approx)


def correlation_matrix(df: DataFrame) -> DataFrame:
    return stats.correlation_matrix(df, CORR_COLUMNS)


def price_sample(df: DataFrame, n: int = 5000, seed: int = 1) -> DataFrame:
    """Q10 scatter data: a reproducible sample of at most ``n`` rows."""
    return stats.sample_rows(df.select("transaction_id", AMOUNT, "discount_percent"),
                             n, "transaction_id", seed)


# --------------------------------------------------------------------------- #
# SQL KPIs (keep the NULL group, like the SQL text they come from)
# --------------------------------------------------------------------------- #
#: Exact for ordinary amounts, plain for what DECIMAL(38,10) cannot hold, as ``money_sum``.
_KPI_REVENUE = """COALESCE(SUM(CASE WHEN NOT {ordinary} AND NOT isnan({x}) THEN {x} END)
                 + COALESCE(CAST(SUM(CASE WHEN {ordinary} THEN CAST({x} AS DECIMAL(38,10)) END) AS DOUBLE), 0D),
               CAST(SUM(CASE WHEN {ordinary} THEN CAST({x} AS DECIMAL(38,10)) END) AS DOUBLE))""".format(
    x=AMOUNT, ordinary=f"({AMOUNT} = 0 OR (abs({AMOUNT}) >= 1e-4D AND abs({AMOUNT}) < 1e17D))")

KPI_SQL: dict[str, str] = {
    "yearly_revenue": f"""
        SELECT order_year AS year, {_KPI_REVENUE} AS revenue,
               COUNT(*) AS orders, COUNT(DISTINCT customer_id) AS customers
        FROM {{t}} GROUP BY order_year ORDER BY order_year""",
    "category_revenue": f"""
        SELECT category, {_KPI_REVENUE} AS revenue, COUNT(*) AS orders
        FROM {{t}} GROUP BY category ORDER BY revenue DESC""",
    "top_cities": f"""
        SELECT customer_city AS city, {_KPI_REVENUE} AS revenue
        FROM {{t}} GROUP BY customer_city
        ORDER BY revenue DESC, city LIMIT 10""",
}


def run_kpi(df: DataFrame, name: str) -> DataFrame:
    """Run one KPI SQL text over ``df``; no view is left that could hide a table."""
    return df.sparkSession.sql(KPI_SQL[name], t=df)


# --------------------------------------------------------------------------- #
# Dashboard filter
# --------------------------------------------------------------------------- #
def filter_options(df: Source) -> DataFrame:
    """Distinct non-NULL years, categories and tiers (the filter choices),
    long form (kind, value): one pass down to the combinations present, then their parts."""
    frame, _ = _source(df)
    kinds = (("year", "order_year"), ("category", "category"), ("tier", "customer_tier"))
    cells = frame.select(*[c for _, c in kinds]).distinct()
    parts = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).cast("string").alias("value")) for k, c in kinds])
    return cells.select(F.inline(parts)).where(F.col("value").isNotNull()).distinct()


def global_filters(df: Source, years: tuple[int, int] | None = None,
                   categories: list[str] | None = None, tiers: list[str] | None = None) -> Source:
    """Year range (inclusive), category and tier membership. ``None`` means
    every non-NULL value (the default selection); an empty list keeps nothing.
    The predicates reach the Parquet scan / partition filter; over states they pick cells."""
    if isinstance(df, ReportStates):
        return df.filtered(years, categories, tiers)
    return df.where(filter_condition(years, categories, tiers))


#: Every table of the EDA questions; a question with several has one name for each.
EDA_QUESTIONS = {
    "q01_revenue_trend": yoy_growth, "q02_seasonality": month_year_heatmap, "q03_rfm": rfm,
    "q04_payment_evolution": payment_share, "q05_category_performance": category_share,
    "q06_prime_impact": prime_impact, "q07_geography": top_cities, "q07_geography_tiers": tier_revenue,
    "q08_festival_impact": festival_daily, "q09_age_behavior": age_category_share,
    "q10_price_demand": correlation_matrix, "q10_price_demand_sample": price_sample,
    "q11_delivery_performance": delivery_histogram, "q11_delivery_performance_tiers": delivery_by_tier,
    "q12_returns": return_rate_by_category, "q12_returns_rating_box": rating_box_by_return,
    "q13_brand_performance": top_brands, "q14_clv_cohort": cohort_retention_first_year_base,
    "q15_discount_effectiveness": discount_bands,
    "q16_rating_sales": aov_by_rating, "q16_rating_sales_histogram": rating_histogram,
    "q17_customer_journey": purchase_frequency, "q18_product_lifecycle": category_lifecycle,
    "q19_competitive_pricing": price_box_by_category, "q20_business_health": business_health,
}

#: Quantiles, correlations and samples do not add up: these read the fact themselves.
NOT_ADDITIVE = frozenset({"q10_price_demand", "q10_price_demand_sample", "q12_returns_rating_box", "q19_competitive_pricing"})
