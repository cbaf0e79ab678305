"""Queries through the sinks that check, de-duplicate and replace: written under the checkpoint folder, read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from bazaar.plans.registry import register
from bazaar.session import ensure_checkpoint_dir
from bazaar.sources import files as IO
from bazaar.sources import layout as L
from bazaar.sources.incremental import KeepFirst
from bazaar.sources.scratch import materialize
from bazaar.sources.tables import sales
from bazaar.sources.validate import Rules, judged, write_validated
from bazaar.sources.versions import Versions


def _folder(spark, label: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/bazaar-{label}-{uuid.uuid4().hex}"


# The year 1996 comes twice, customers of every 50th number are unknown, one category is not in the vocabulary.
_KINDS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL"]


def _load(spark, sf_dir):
    fact = sales(spark, sf_dir).select("transaction_id", "customer_id", "category", "discount_percent", "order_year")
    twice = fact.withColumn("copy", F.lit(0)).unionAll(fact.where("order_year = 1996").withColumn("copy", F.lit(1)))
    parents = fact.where("cast(customer_id as int) % 50 <> 0").select("customer_id").distinct()
    return twice, Rules(checks={"discount up to 45": F.col("discount_percent") <= 45}, vocabularies={"category": _KINDS},
                        unique={"transaction repeated": ["transaction_id"]}, foreign={"customer_id": (parents, "customer_id")},
                        order=["copy", "customer_id", "category", "discount_percent", "order_year"])


_JUDGED = f"""
with twice as (select transaction_id, customer_id, category, discount_percent, order_year, 0 as copy from sales
               union all select transaction_id, customer_id, category, discount_percent, order_year, 1 from sales where order_year = 1996),
j as (select transaction_id, copy, discount_percent > 45 as b1, category not in ({", ".join(f"'{k}'" for k in _KINDS)}) as b2,
             row_number() over (partition by transaction_id order by copy, customer_id, category, discount_percent, order_year) > 1 as b3, cast(customer_id as int) % 50 = 0 as b4
      from twice)"""

register("validated_load", oracle=f"""
select * from ({_JUDGED}
select 'good' as rule, count(*) filter (where not (b1 or b2 or b3 or b4)) as rows from j
union all select 'quarantined', count(*) filter (where b1 or b2 or b3 or b4) from j
union all select 'discount up to 45', count(*) filter (where b1) from j having count(*) filter (where b1) > 0
union all select 'category not in vocabulary', count(*) filter (where b2) from j having count(*) filter (where b2) > 0
union all select 'transaction repeated', count(*) filter (where b3) from j having count(*) filter (where b3) > 0
union all select 'customer_id has no parent', count(*) filter (where b4) from j having count(*) filter (where b4) > 0) q""")(
    lambda s, d: write_validated(_load(s, d)[0], _folder(s, "validated"), _load(s, d)[1]))

register("quarantined_rows", oracle=f"""
select * from ({_JUDGED}
select transaction_id, copy, array_to_string(list_filter([case when b2 then 'category not in vocabulary' end,
         case when b4 then 'customer_id has no parent' end, case when b1 then 'discount up to 45' end,
         case when b3 then 'transaction repeated' end], lambda x: x is not null), '; ') as reasons
from j where b1 or b2 or b3 or b4) q""")(
    lambda s, d: judged(*_load(s, d)).where("size(_broken) > 0")
    .select("transaction_id", "copy", F.concat_ws("; ", "_broken").alias("reasons")))


@register("keep_first_loads", rounding={"final_amount_inr": 4}, oracle="""
select customer_id, transaction_id, order_date, final_amount_inr from (
  select *, row_number() over (partition by customer_id order by transaction_id, order_date, final_amount_inr) as rn from sales) t where rn = 1""")
def keep_first_loads(spark, sf_dir):
    """Three loads that arrive out of order give the first row of every customer."""
    fact = materialize(sales(spark, sf_dir).select("customer_id", "transaction_id", "order_date", "order_year",
                                                   "final_amount_inr"), "keep-first-rows", codec="zstd")     # read by three loads
    table = KeepFirst(spark, _folder(spark, "keep-first"), "customer_id",
                      ["transaction_id", "order_date", "final_amount_inr"])
    for part in (1, 2, 0):
        table.load(fact.where(F.col("order_year") % 3 == part).drop("order_year"))
    return table.table()


@register("warehouse_point_reads", rounding={"revenue": 4}, oracle="""
select 'category' as path, category as value, count(*) as rows, fsum(final_amount_inr) as revenue from sales
where category = 'PROMO' group by category
union all select 'city', customer_city, count(*), fsum(final_amount_inr) from sales where customer_city like '%/1' group by customer_city
union all select 'product', product_id, count(*), fsum(final_amount_inr) from sales where product_id in ('1', '7', '50') group by product_id""")
def warehouse_point_reads(spark, sf_dir):
    """The curve layout read by each of its columns."""
    from bazaar.functions import money_sum
    fact = sales(spark, sf_dir)
    versions = Versions(spark, _folder(spark, "warehouse"))
    version = versions.stage()
    L.along_curve(fact, list(IO.CURVE_COLUMNS), ["order_year"]).write.partitionBy("order_year") \
        .options(**L.bloom_options(list(IO.BLOOM_COLUMNS))).parquet(versions.folder(version, "transactions"))
    versions.commit(version, ["transactions"])
    table = versions.read("transactions")

    def read(path, column, cond):
        return table.where(cond).groupBy(F.lit(path).alias("path"), F.col(column).alias("value")).agg(
            F.count(F.lit(1)).alias("rows"), money_sum("final_amount_inr").alias("revenue"))
    return (read("category", "category", F.col("category") == "PROMO")
            .unionAll(read("city", "customer_city", F.col("customer_city").endswith("/1")))
            .unionAll(read("product", "product_id", F.col("product_id").isin("1", "7", "50"))))
