"""The ten cleaning steps (CL1-CL13) as DataFrame -> DataFrame jobs, plus the
audit report.

Order matters and follows the source pipeline: dates, prices, categories,
price outliers, ratings (with imputation), cities, booleans, delivery days
(with imputation), payment methods, de-duplication, then invalid rows are
dropped. Medians are therefore taken over all raw rows, duplicates and
undated rows included.

Scale notes: group medians that feed imputation are aggregations joined back
on their key (the fact is shuffled at most once per join, and AQE broadcasts
the small median table or splits a skewed key); keep-first de-duplication is
a ``min_by`` aggregation, which combines map-side, so a hot id never lands
in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.functions import (
    canonical_lookup, parse_date, parse_delivery_days, parse_price, parse_rating, to_bool,
)
from bazaar.operators import stats
from bazaar.operators.joins import lookup_join
from bazaar.sources.scratch import materialize, spread
from bazaar.schema import (
    BOOLEAN_COLUMNS, CATEGORY_CANONICAL, CITY_CANONICAL, DEFAULT_DATE_WINDOW, OUTLIER_DIVISOR,
    OUTLIER_FACTOR, PAYMENT_CANONICAL, UNKNOWN_PAYMENT,
)


def clean_dates(df: DataFrame, col: str = "order_date",
                window: tuple[str, str] | None = DEFAULT_DATE_WINDOW) -> DataFrame:
    """CL1: multi-format parse, window check, then year / month / quarter."""
    d = parse_date(F.col(col), window)
    out = df.withColumn(col, d)
    return (out.withColumn("order_year", F.year(col).cast("int"))
               .withColumn("order_month", F.month(col).cast("int"))
               .withColumn("order_quarter", F.quarter(col).cast("int")))


def clean_prices(df: DataFrame, col: str = "original_price_inr") -> DataFrame:
    """CL2: strip currency text; 'Price on Request' and junk -> NULL."""
    return df.withColumn(col, parse_price(col))


def clean_ratings(df: DataFrame, col: str = "customer_rating") -> DataFrame:
    """CL3: parse rating text to a 0.5-step value in [1, 5] (no imputation)."""
    return df.withColumn(col, parse_rating(col))


def impute_ratings(df: DataFrame, col: str = "customer_rating", by: str = "product_id") -> DataFrame:
    """CL3b/c: fill a missing rating with its product's median, then with the
    median of the product-filled column. Ratings take at most 17 distinct
    values, so the built-in exact ``median`` buffer stays tiny."""
    if by in df.columns:
        med = (df.where(F.col(by).isNotNull()).groupBy(by)
                 .agg(F.median(col).alias("_pmed")))
        df = lookup_join(df, med, by, "left", label="product-median") \
               .withColumn(col, F.coalesce(F.col(col), F.col("_pmed"))).drop("_pmed")
    overall = df.agg(F.median(col)).scalar()
    return df.withColumn(col, F.coalesce(F.col(col), overall))


def clean_cities(df: DataFrame, col: str = "customer_city") -> DataFrame:
    """CL4: alias map on lower(strip), else Title Case; NULL stays NULL."""
    return df.withColumn(col, canonical_lookup(col, CITY_CANONICAL))


def clean_booleans(df: DataFrame, cols: tuple[str, ...] = BOOLEAN_COLUMNS) -> DataFrame:
    """CL5: truthy tokens -> true, everything else (missing too) -> false."""
    for c in cols:
        if c in df.columns:
            df = df.withColumn(c, to_bool(c))
    return df


def clean_categories(df: DataFrame, col: str = "category") -> DataFrame:
    """CL6: alias map, else Title Case; NULL stays NULL."""
    return df.withColumn(col, canonical_lookup(col, CATEGORY_CANONICAL))


def clean_delivery_days(df: DataFrame, col: str = "delivery_days", negatives: str = "abs",
                        decimals: bool = False) -> DataFrame:
    """CL7: parse delivery text (no imputation)."""
    return df.withColumn(col, parse_delivery_days(col, negatives=negatives, decimals=decimals))


def impute_delivery_days(df: DataFrame, col: str = "delivery_days") -> DataFrame:
    """CL7b: fill missing days with the exact global median (distributed)."""
    med = stats.exact_quantiles(df, [], col, [0.5], ["m"]).select("m").scalar()
    return df.withColumn(col, F.coalesce(F.col(col), med))


def fix_price_outliers(df: DataFrame, price_col: str = "original_price_inr",
                       category_col: str = "category", approx: bool = False) -> DataFrame:
    """CL9: a price above 50 x its category's median is a decimal-point error
    and is divided by 100 (NULL category or a median <= 0: untouched).

    The exact median per category comes from the radix selection job, so a
    category holding most rows is still counted in many tasks;
    ``approx=True`` takes the bounded-memory sketch median instead."""
    if category_col not in df.columns:
        return df
    med = stats.median_by(df, [category_col], price_col, "_cmed", approx=approx)
    j = lookup_join(df, med, category_col, "left", label="category-median")
    m, p = F.col("_cmed"), F.col(price_col)
    bad = m.isNotNull() & (m > 0) & (p > m * OUTLIER_FACTOR)
    return j.withColumn(price_col, F.when(bad, p / OUTLIER_DIVISOR).otherwise(p)).drop("_cmed")


def clean_payments(df: DataFrame, col: str = "payment_method") -> DataFrame:
    """CL10: alias map, else Title Case; missing -> 'Unknown'."""
    return df.withColumn(col, canonical_lookup(col, PAYMENT_CANONICAL, UNKNOWN_PAYMENT))


def dedup_keep_first(df: DataFrame, key: str = "transaction_id",
                     order: list[str] | None = None) -> DataFrame:
    """CL8: one row per ``key`` (NULL keys collapse to one), the first in
    ``order``. ``min`` and ``min_by`` combine map-side, so a key repeated across the
    whole table is reduced in every task before the shuffle."""
    payload = [c for c in df.columns if c != key]
    order = order or payload
    if set(order) - {key} == set(payload):      # the order holds the whole row: it is carried once
        first = F.min(F.struct(*[c for c in order if c != key]))
    else:
        first = F.min_by(F.struct(*payload), F.struct(*order))
    picked = df.groupBy(key).agg(first.alias("_row"))
    return picked.select(*[F.col(key) if c == key else F.col(f"_row.{c}").alias(c) for c in df.columns])


def drop_invalid(df: DataFrame, subset: tuple[str, ...] = ("order_date", "final_amount_inr")) -> DataFrame:
    """CL11: drop rows missing a date or an amount."""
    return df.dropna(subset=[c for c in subset if c in df.columns])


# --------------------------------------------------------------------------- #
# Pipeline and report
# --------------------------------------------------------------------------- #
NUMERIC_TEXT_COLUMNS = ("product_rating", "discount_percent", "final_amount_inr", "delivery_charges")


@dataclass
class Cleaned:
    clean: DataFrame
    report: DataFrame


def null_fractions(df: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    """CL12/A20: fraction of NULLs per column, long form (column, null_pct)."""
    cols = [c for c in df.columns if c not in exclude]
    one = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(f"_n{i}") for i, c in enumerate(cols)])
    entries = [F.struct(F.lit(c).alias("column"), (F.col(f"_n{i}") * 100).alias("null_pct"))
               for i, c in enumerate(cols)]
    return one.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def _fmt_int(c: Column) -> Column:
    return F.format_number(c, 0)


def cleaning_report(raw: DataFrame, deduped: DataFrame, clean: DataFrame,
                    exclude: tuple[str, ...] = ()) -> DataFrame:
    """CL12: (step, detail) rows in order duplicates, dropped_invalid, rows,
    null_pct. Counts are scalar subqueries over the three stages."""
    n_raw = raw.agg(F.count(F.lit(1))).scalar()
    n_dedup = deduped.agg(F.count(F.lit(1))).scalar()
    cols = [c for c in clean.columns if c not in exclude]
    per_col = [F.avg(F.col(c).isNull().cast("double")) for c in cols]
    stats_row = clean.agg(F.count(F.lit(1)).alias("n_clean"),
                          (sum(per_col[1:], per_col[0]) / len(cols) * 100).alias("pct"))
    rows = F.array(
        F.struct(F.lit(1).alias("step_order"), F.lit("duplicates").alias("step"),
                 F.concat(F.lit("removed "), (n_raw - n_dedup).cast("string"),
                          F.lit(" duplicate transaction_ids")).alias("detail")),
        F.struct(F.lit(2).alias("step_order"), F.lit("dropped_invalid").alias("step"),
                 F.concat(F.lit("removed "), (n_dedup - F.col("n_clean")).cast("string"),
                          F.lit(" rows missing date/amount")).alias("detail")),
        F.struct(F.lit(3).alias("step_order"), F.lit("rows").alias("step"),
                 F.concat(_fmt_int(n_raw), F.lit(" raw -> "), _fmt_int(F.col("n_clean")),
                          F.lit(" clean")).alias("detail")),
        F.struct(F.lit(4).alias("step_order"), F.lit("null_pct").alias("step"),
                 F.concat(F.call_function("format_number", F.col("pct"), F.lit("0.00")),
                          F.lit("% mean null across columns")).alias("detail")),
    )
    return stats_row.select(F.explode(rows).alias("r")).select("r.*")


def parse_all(raw: DataFrame, window: tuple[str, str] | None = DEFAULT_DATE_WINDOW,
              negatives: str = "abs", decimals: bool = False) -> DataFrame:
    """Every row-wise step of the pipeline (no aggregates), in one projection.
    Numeric columns that arrive as text are cast (bad text -> NULL)."""
    df = raw
    for c in NUMERIC_TEXT_COLUMNS:
        if c in df.columns and dict(df.dtypes)[c] == "string":
            # a cast alone would take Java's '1d' and '12f' for numbers
            number = ~F.lower(F.trim(F.col(c))).rlike("[0-9.][df]$")
            df = df.withColumn(c, F.when(number, F.col(c).try_cast("double")))
    df = clean_dates(df, window=window)
    df = clean_prices(df)
    df = clean_categories(df)
    df = clean_ratings(df)
    df = clean_cities(df)
    df = clean_booleans(df)
    df = clean_delivery_days(df, negatives=negatives, decimals=decimals)
    return clean_payments(df)


def clean_pipeline(raw: DataFrame, window: tuple[str, str] | None = DEFAULT_DATE_WINDOW,
                   order: list[str] | None = None, negatives: str = "abs",
                   decimals: bool = False, cut_lineage: bool = True) -> Cleaned:
    """CL13: the whole chain with the source semantics, plus the audit report.

    The row-wise parses run in one pass and the result is written as Parquet
    to the shared checkpoint folder (a lineage cut), so the median jobs (category price with
    global delivery as one job, product rating) and the apply step read it instead of
    re-running the parse. All medians see every raw row (duplicates and
    undated rows included), exactly as in the sequential original; the
    global rating median is taken over the product-filled column.

    ``order`` names the columns that give the raw row order (file, line);
    they decide keep-first and are left out of the null statistics.
    """
    order = order or []
    parsed = parse_all(spread(raw), window, negatives, decimals)
    if cut_lineage:
        parsed = materialize(parsed, "parsed")
    # The category price medians and the global delivery median are one
    # exact-quantile job over (measure, key, value) rows; its small result
    # is written once and split.
    meds = materialize(stats.exact_median(
        parsed.select(F.lit("price").alias("_m"), F.col("category").alias("_k"),
                      F.col("original_price_inr").cast("double").alias("_v"))
        .unionByName(parsed.select(F.lit("delivery").alias("_m"), F.lit("").alias("_k"),
                                   F.col("delivery_days").cast("double").alias("_v"))),
        ["_m", "_k"], "_v", "_med"), "medians")
    cat_med = meds.where(F.col("_m") == "price").select(
        F.col("_k").alias("category"), F.col("_med").alias("_cmed"))
    deliv_med = meds.where(F.col("_m") == "delivery").select("_med").scalar()
    # One count of ratings per product gives the product medians and, with the missing ratings
    # filled from them, the global one: neither needs the joined rows. A rating has 17 values at most.
    rated = materialize(parsed.groupBy("product_id", "customer_rating").agg(F.count(F.lit(1)).alias("_n")), "ratings")
    prod_med = materialize(rated.where("product_id is not null and customer_rating is not null").groupBy("product_id")
                           .agg(F.percentile("customer_rating", 0.5, F.col("_n")).alias("_pmed")), "product-median")
    rating_med = rated.join(prod_med, "product_id", "left") \
        .select(F.coalesce("customer_rating", "_pmed").alias("_r"), "_n").where("_r is not null") \
        .agg(F.percentile("_r", 0.5, F.col("_n"))).scalar()

    df = lookup_join(parsed, cat_med, "category", "left", written=True)
    df = lookup_join(df, prod_med, "product_id", "left", written=True)
    m, p = F.col("_cmed"), F.col("original_price_inr")
    bad = m.isNotNull() & (m > 0) & (p > m * OUTLIER_FACTOR)
    df = (df.withColumn("original_price_inr", F.when(bad, p / OUTLIER_DIVISOR).otherwise(p))
            .withColumn("customer_rating", F.coalesce(F.col("customer_rating"), F.col("_pmed"), rating_med))
            .withColumn("delivery_days", F.coalesce(F.col("delivery_days"), deliv_med))
            .select(*parsed.columns))

    deduped = dedup_keep_first(df, "transaction_id", order or None)
    if cut_lineage:
        # second cut: the clean output and the three report counts all read
        # this instead of re-running the joins and the de-duplication shuffle
        deduped = materialize(deduped, "deduped")
    clean = drop_invalid(deduped)
    helpers = tuple(c for c in order if c.startswith("_"))
    clean = clean.drop(*helpers)
    report = cleaning_report(parsed, deduped, clean, exclude=tuple(order))
    return Cleaned(clean, report)
