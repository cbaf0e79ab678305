"""All additive reports from one scan, also after a filter.

One grouping-sets aggregation turns the fact into a long table of states: per report set its
keys, and counts and exact sums that add up (some sets by way of a joint set, see ``JOINTS``). Every set also carries the three filter
keys (year, category, tier), so a filtered report is an aggregation over the states of one
set; the fact is not read again. Distinct customers, which do not add up, are kept as
bitmaps per filter cell.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.functions import discount_band, money_avg, money_limbs, money_of_limbs, money_sum, money_total
from bazaar.operators import dictionary
from bazaar.sources.scratch import materialize, scratch_path

AMOUNT = "final_amount_inr"
FILTER_KEYS = ["order_year", "category", "customer_tier"]

#: Report sets: the keys that each holds besides the filter keys.
SETS: dict[str, list[str]] = {
    "cell": [],
    "time": ["order_quarter", "order_month", "order_date", "is_festival_sale"],
    "payment": ["payment_method"],
    "age": ["age_group"],
    "brand": ["brand"],
    "place": ["customer_state", "customer_city"],
    "band": ["band"],
    "prime": ["is_prime_member"],
    "rating": ["customer_rating"],
    "delivery": ["delivery_days"],
    "product": ["product_name"],
    "spending": ["customer_spending_tier"],
    "customer": ["customer_id"],
}

#: Sets of few keys that :meth:`ReportStates.build` first counts jointly: the fact's rows are repeated once for
#: all sets of a joint, whose few groups then give each set. The rest is counted from the fact by itself.
JOINTS: dict[str, list[str]] = {
    "joint-payment": ["cell", "payment", "age", "spending"],
    "joint-brand": ["brand", "rating"],
    "joint-place": ["place", "band"],
    "joint-delivery": ["delivery", "prime"],
}

#: Measures by name, over the rows of the fact and over states. The revenue of nothing but missing
#: amounts is 0, their mean is NULL.
Measures = dict[str, Callable[[], Column]]


def _returned() -> Column:
    return F.col("return_status") == "Returned"


FACT: Measures = {
    "rows": lambda: F.count(F.lit(1)),
    "orders": lambda: F.count("transaction_id"),
    "revenue": lambda: F.coalesce(money_sum(AMOUNT), F.lit(0.0)),
    "aov": lambda: money_avg(AMOUNT),
    "returned_pct": lambda: F.count_if(F.coalesce(_returned(), F.lit(False))) / F.count(F.lit(1)) * 100,
    "avg_delivery_days": lambda: F.avg("delivery_days"),
    "last": lambda: F.max("order_date"),
}


def _count(state: str) -> Column:
    return F.coalesce(F.sum(state), F.lit(0)).cast("long")


def _money() -> Column:
    return money_total(F.sum("exact"), F.sum("odd"))


STATES: Measures = {
    "rows": lambda: _count("rows"),
    "orders": lambda: _count("orders"),
    "revenue": lambda: F.coalesce(_money(), F.lit(0.0)),
    "aov": lambda: F.try_divide(_money(), F.sum("priced")),
    "returned_pct": lambda: F.sum("returned") / F.sum("rows") * 100,
    "avg_delivery_days": lambda: F.try_divide(F.sum("days"), F.sum("delivered")),
    "last": lambda: F.max("last"),
}


def _with_band(fact: DataFrame) -> DataFrame:
    return fact if "band" in fact.columns else fact.withColumn("band", discount_band("discount_percent"))


def _sets_of(columns: list[str]) -> dict[str, list[str]]:
    """The sets whose keys are all among ``columns``, with the filter keys."""
    return {name: [*FILTER_KEYS, *keys] for name, keys in SETS.items() if set(keys) <= set(columns)}


def _grouped(rows: DataFrame, sets: dict[str, list[str]], cols: list[str], *states: Column) -> DataFrame:
    """One aggregation of ``rows`` by all ``sets``, with report_set."""
    # bit i of the grouping id (from the left) is set where column i is not in the set
    number = {sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in keys): name for name, keys in sets.items()}
    named = F.coalesce(*[F.when(F.col("_set") == n, F.lit(name)) for n, name in number.items()])
    return (rows.groupingSets([[F.col(c) for c in keys] for keys in sets.values()], *[F.col(c) for c in cols])
            .agg(F.grouping_id().alias("_set"), *states).withColumn("report_set", named).drop("_set"))


def report_states(fact: DataFrame) -> DataFrame:
    """The states of all report sets in one aggregation of ``fact``: report_set, the keys of
    all sets (NULL where a set has not the key), rows, orders, exact and odd (sums of amounts),
    priced (amounts present), returned, delivered and days (count and sum of delivery days), last (date).

    Absent optional columns leave their set out. A NULL key is a group of its own.
    """
    fact = _with_band(fact)
    return _states_by(fact, _sets_of(fact.columns))


def _states_by(fact: DataFrame, sets: dict[str, list[str]]) -> DataFrame:
    cols = list(dict.fromkeys(c for keys in _sets_of(fact.columns).values() for c in keys))
    # whatever needs one row only is done before the row is repeated for every set
    amount = F.col(AMOUNT).cast("double")
    limbs, odd = money_limbs(AMOUNT)
    fact = fact.select(
        *[F.col(c) for c in cols], *[limb.alias(f"_limb{i}") for i, limb in enumerate(limbs)], odd.alias("_odd"),
        F.coalesce(_returned(), F.lit(False)).alias("_returned"), (amount.isNotNull() & ~F.isnan(amount)).alias("_priced"),
        F.col("transaction_id").isNotNull().alias("_order"), F.col("delivery_days").alias("_days"), F.col("order_date").alias("_date"))
    return _grouped(
        fact, sets, cols,
        F.count(F.lit(1)).alias("rows"), F.count_if("_order").alias("orders"),
        money_of_limbs(*[F.sum(f"_limb{i}") for i in range(len(limbs))]).alias("exact"), F.sum("_odd").alias("odd"),
        F.count_if("_priced").alias("priced"), F.count_if("_returned").alias("returned"),
        F.count("_days").alias("delivered"), F.sum("_days").alias("days"),
        F.max("_date").alias("last"))


def _joints_of(sets: dict[str, list[str]]) -> dict[str, dict[str, list[str]]]:
    """The sets of each joint, of those there are (one by itself is no joint)."""
    joints = {joint: {name: sets[name] for name in names if name in sets} for joint, names in JOINTS.items()}
    return {joint: own for joint, own in joints.items() if len(own) > 1}


def _write_states(fact: DataFrame, path: str) -> None:
    """Writes :func:`report_states`, and the joints beside them: the sets that are not of a joint and the joints from
    one scan of ``fact``, then the sets of the joints from those."""
    fact = _with_band(fact)
    sets = _sets_of(fact.columns)
    joints = _joints_of(sets)
    first = {name: keys for name, keys in sets.items() if not any(name in own for own in joints.values())}
    first |= {joint: list(dict.fromkeys(c for keys in own.values() for c in keys)) for joint, own in joints.items()}
    _states_by(fact, first).write.mode("overwrite").partitionBy("report_set").parquet(path)
    written = fact.sparkSession.read.parquet(path)
    cols = [c for c in written.columns if any(c in keys for keys in sets.values())]
    counts = [F.sum(c).alias(c) for c in ("rows", "orders", "exact", "odd", "priced", "returned", "delivered", "days")]
    parts = [_grouped(written.where(F.col("report_set") == joint).drop("report_set"), own, cols, *counts, F.max("last").alias("last"))
             for joint, own in joints.items()]
    if parts:
        reduce(DataFrame.unionByName, parts).write.mode("append").partitionBy("report_set").parquet(path)


def filter_condition(years: tuple[int, int] | None = None, categories: list[str] | None = None,
                     tiers: list[str] | None = None) -> Column:
    """Year range (inclusive), category and tier membership. ``None`` means every non-NULL value
    (the default selection); an empty list keeps nothing."""
    cond = F.col("order_year").isNotNull() if years is None else \
        F.col("order_year").between(int(years[0]), int(years[1]))
    for name, chosen in (("category", categories), ("customer_tier", tiers)):
        cond = cond & (F.col(name).isNotNull() if chosen is None else
                       F.col(name).isin(*chosen) if chosen else F.lit(False))
    return cond


@dataclass(frozen=True)
class ReportStates:
    """Written states, read per set; reports take it in place of the fact."""

    table: DataFrame            # report_states and the joints, partitioned by report_set
    bits: DataFrame | None      # filter keys, bucket, bits: customers of every cell
    columns: tuple[str, ...]    # columns that reports can be grouped by

    @classmethod
    def build(cls, fact: DataFrame, path: str | None = None, customers: bool = True) -> ReportStates:
        """One scan of ``fact`` and its joints, then one of the customer states for the bitmaps (not with
        ``customers=False``: then no report can count distinct customers). ``path`` keeps the
        tables (:meth:`open` reads them); without it they are intermediates."""
        spark = fact.sparkSession
        to = scratch_path(spark, "states") if path is None else f"{path}/states"
        _write_states(fact, to)
        table = spark.read.parquet(to)
        if not customers:
            return cls._of(table, None)
        members = table.where("report_set = 'customer'")
        bits = dictionary.bitmaps(members, FILTER_KEYS, "customer_id")
        if path is None:
            return cls._of(table, materialize(bits, "customer-bits"))
        bits.write.mode("overwrite").parquet(f"{path}/bits")
        return cls.open(spark, path)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> ReportStates:
        """The tables that :meth:`build` wrote with customers."""
        return cls._of(spark.read.parquet(f"{path}/states"), spark.read.parquet(f"{path}/bits"))

    @classmethod
    def _of(cls, table: DataFrame, bits: DataFrame | None) -> ReportStates:
        return cls(table, bits, tuple(c for c in table.columns if c != "report_set"))

    @property
    def sparkSession(self) -> SparkSession:     # noqa: N802 - as a DataFrame names it
        return self.table.sparkSession

    def filtered(self, years: tuple[int, int] | None = None, categories: list[str] | None = None,
                 tiers: list[str] | None = None) -> ReportStates:
        """The states of the rows that the filter keeps: whole cells, so no fact is needed."""
        keep = filter_condition(years, categories, tiers)
        return ReportStates(self.table.where(keep), None if self.bits is None else self.bits.where(keep), self.columns)

    def covering(self, *keys: str) -> DataFrame:
        """The states of the first, smallest set that has all of ``keys``."""
        for name, own in SETS.items():
            if set(keys) <= {*FILTER_KEYS, *own}:
                return self.table.where(F.col("report_set") == name)
        raise KeyError(f"no report set has all of {keys}")

    def customers(self, *keys: str) -> DataFrame:
        """(keys, customers): exact distinct customers by some of the filter keys."""
        return dictionary.union_counts(self._bits(), list(keys), "customers")

    def cohort_counts(self) -> DataFrame:
        """(cohort, order_year, customers) as ``reports.cohort_counts``."""
        return dictionary.first_seen_counts(self._bits(), "order_year", "cohort", "customers")

    def _bits(self) -> DataFrame:
        if self.bits is None:
            raise KeyError("these states were built without customers")
        return self.bits


def customer_rollup(fact: DataFrame) -> DataFrame:
    """Exact distinct customers for every subset of the filter keys (as a cube): order_year, category,
    customer_tier, level (1, 2 and 4 for a key rolled up), customers. One set of bitmaps serves all
    subsets; a distinct count would need the fact once for each."""
    bits = materialize(dictionary.bitmaps(fact, FILTER_KEYS, "customer_id"), "customer-bits")
    cells = fact.groupBy(*FILTER_KEYS).agg(F.count(F.lit(1)).alias("_rows"))       # also those without customers
    bits = cells.withColumnsRenamed({k: f"_{k}" for k in FILTER_KEYS}).join(
        bits, F.expr(" and ".join(f"{k} <=> _{k}" for k in FILTER_KEYS)), "left").select(
        *[F.col(f"_{k}").alias(k) for k in FILTER_KEYS], "bucket", "bits")
    level = sum(((F.grouping(k) * (1 << i)) for i, k in enumerate(FILTER_KEYS)), F.lit(0))
    subsets = [[F.col(k) for i, k in enumerate(FILTER_KEYS) if n >> i & 1] + [F.col("bucket")] for n in range(1 << len(FILTER_KEYS))]
    union = bits.groupingSets(subsets, *[F.col(k) for k in FILTER_KEYS], F.col("bucket")).agg(
        level.alias("level"), F.bitmap_or_agg("bits").alias("bits"))
    return union.groupBy(*FILTER_KEYS, "level").agg(
        F.coalesce(F.sum(F.when(F.col("bucket").isNotNull(), F.bitmap_count("bits"))), F.lit(0)).alias("customers"))
