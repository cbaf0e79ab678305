"""The driver's star tables and the retail views built on them.

``sales`` is the clean 28-column fact (one row per line item) derived from
lineitem x orders x customer x nation x region x part. ``messy`` (in
``bazaar.operators.inject``) dirties ``orders`` for the cleaners.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.schema import CLEAN_SCHEMA
from bazaar.sources.scratch import spread

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later.cast("date"), earlier.cast("date"))


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean fact in the dictionary's column order and types.

    Join order: a shuffle of line items carries what was joined before it, so the parts come
    first, and orders meet their customers (nation and region are broadcast by their file
    statistics) before the line items, which are shuffled by part and by order only. AQE splits a
    skewed key partition.
    """
    li = spread(table(spark, sf_dir, "lineitem"))
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    p = table(spark, sf_dir, "part")

    cust = (c.join(n, c.c_nationkey == n.n_nationkey)
             .join(r, n.n_regionkey == r.r_regionkey))
    placed = o.join(cust, o.o_custkey == cust.c_custkey)
    fact = (li.join(p, li.l_partkey == p.p_partkey)
              .join(placed, li.l_orderkey == o.o_orderkey))

    month = F.month("o_orderdate")
    festive = month.isin(10, 11)
    cols = {
        "transaction_id": F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                                   F.col("l_linenumber").cast("string")),
        "customer_id": F.col("o_custkey").cast("string"),
        "product_id": F.col("l_partkey").cast("string"),
        "product_name": F.col("p_name"),
        "category": F.col("p_type"),
        "subcategory": F.concat(F.lit("S"), (F.col("p_size") % 4).cast("string")),
        "brand": F.col("p_brand"),
        "product_rating": (F.lit(1.0) + (F.col("p_size") % 9) * 0.5).cast("double"),
        "order_date": F.col("o_orderdate").cast("date"),
        "order_year": F.year("o_orderdate").cast("int"),
        "order_month": month.cast("int"),
        "order_quarter": F.quarter("o_orderdate").cast("int"),
        "original_price_inr": F.col("l_extendedprice"),
        "discount_percent": F.round(F.col("l_discount") * 500, 6),
        "final_amount_inr": F.col("l_extendedprice") * (1 - F.col("l_discount")),
        "delivery_charges": F.col("l_tax") * 100,
        "customer_city": F.concat(F.col("n_name"), F.lit("/"), (F.col("c_custkey") % 4).cast("string")),
        "customer_state": F.col("n_name"),
        "customer_tier": F.col("r_name"),
        "age_group": F.col("c_mktsegment"),
        "is_prime_member": F.col("c_acctbal") >= 5000,
        "payment_method": F.col("o_orderpriority"),
        "delivery_days": (F.abs(days_between(F.col("l_shipdate"), F.col("o_orderdate"))) % 16)
        .cast("double"),
        "return_status": F.when(F.col("l_returnflag") == "R", "Returned").otherwise("Not Returned"),
        "customer_rating": (F.lit(1.0) + (F.col("l_quantity").cast("int") % 9) * 0.5).cast("double"),
        "is_festival_sale": festive,
        "festival_name": F.when(festive, F.lit("Diwali")),
        "customer_spending_tier": (F.when(F.col("c_acctbal") < 0, "Low")
                                   .when(F.col("c_acctbal") < 3000, "Medium")
                                   .when(F.col("c_acctbal") < 7000, "High")
                                   .otherwise("Premium")),
    }
    return fact.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in CLEAN_SCHEMA.fields])


# Oracle (DuckDB) text of the same view; shared by every oracle query.
SALES_SQL = """
select concat(cast(l_orderkey as varchar), '-', cast(l_linenumber as varchar)) as transaction_id,
       cast(o_custkey as varchar) as customer_id, cast(l_partkey as varchar) as product_id,
       p_name as product_name, p_type as category,
       concat('S', cast(p_size % 4 as varchar)) as subcategory, p_brand as brand,
       cast(1.0 + (p_size % 9) * 0.5 as double) as product_rating,
       cast(o_orderdate as date) as order_date, cast(year(o_orderdate) as int) as order_year,
       cast(month(o_orderdate) as int) as order_month, cast(quarter(o_orderdate) as int) as order_quarter,
       l_extendedprice as original_price_inr, round(l_discount * 500, 6) as discount_percent,
       l_extendedprice * (1 - l_discount) as final_amount_inr, l_tax * 100 as delivery_charges,
       concat(n_name, '/', cast(c_custkey % 4 as varchar)) as customer_city, n_name as customer_state,
       r_name as customer_tier, c_mktsegment as age_group, c_acctbal >= 5000 as is_prime_member,
       o_orderpriority as payment_method,
       cast(abs(date_diff('day', cast(o_orderdate as date), cast(l_shipdate as date))) % 16 as double) as delivery_days,
       case when l_returnflag = 'R' then 'Returned' else 'Not Returned' end as return_status,
       cast(1.0 + (cast(l_quantity as int) % 9) * 0.5 as double) as customer_rating,
       month(o_orderdate) in (10, 11) as is_festival_sale,
       case when month(o_orderdate) in (10, 11) then 'Diwali' end as festival_name,
       case when c_acctbal < 0 then 'Low' when c_acctbal < 3000 then 'Medium'
            when c_acctbal < 7000 then 'High' else 'Premium' end as customer_spending_tier
from lineitem join orders on l_orderkey = o_orderkey
     join customer on o_custkey = c_custkey
     join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
     join part on l_partkey = p_partkey
"""
