"""Labels, bands and display formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bazaar.schema import DISCOUNT_BANDS, MONEY_DECIMAL
from bazaar.functions.text import _col


def discount_band(c: Column | str) -> Column:
    """Right-closed bins (-1,0], (0,10], (10,20], (20,30], (30,100]; values
    outside every bin (and NULL) give NULL. Spark's ML Bucketizer is
    left-closed, so the bins are an explicit CASE chain."""
    x = _col(c)
    out = None
    for lo, hi, label in DISCOUNT_BANDS:
        cond = (x > lo) & (x <= hi)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


def _fixed2(x: Column) -> Column:
    # DecimalFormat rounds HALF_EVEN on the binary value, like Python's '.2f'.
    return F.call_function("format_number", x, F.lit("0.00"))


def format_inr(c: Column | str) -> Column:
    """Rupee display: >= 1e7 as crore ('₹1.23 Cr'), >= 1e5 as lakh
    ('₹2.50 L'), else a grouped integer ('₹1,234')."""
    x = _col(c).cast("double")
    return (F.when(x >= 1e7, F.concat(F.lit("₹"), _fixed2(x / 1e7), F.lit(" Cr")))
             .when(x >= 1e5, F.concat(F.lit("₹"), _fixed2(x / 1e5), F.lit(" L")))
             .otherwise(F.concat(F.lit("₹"), F.format_number(x, 0))))


def flag_label(c: Column | str, true_label: str, false_label: str) -> Column:
    """Boolean (or 1/0) flag -> display label; NULL stays NULL."""
    x = _col(c).cast("boolean")
    return F.when(x, F.lit(true_label)).when(~x, F.lit(false_label))


def period_label(year: Column | str, quarter: Column | str) -> Column:
    """'2019-Q3' from integer year and quarter."""
    return F.concat_ws("-Q", _col(year).cast("int").cast("string"),
                       _col(quarter).cast("int").cast("string"))


def human_int(c: Column | str) -> Column:
    """Short display of a number: '1.23 Cr' from 1e7, '2.50 L' from 1e5, '1.5 K' from 1e3 on (by
    absolute value), else without decimals."""
    x = _col(c).cast("double")
    size = F.abs(x)
    return (F.when(size >= 1e7, F.concat(_fixed2(x / 1e7), F.lit(" Cr")))
             .when(size >= 1e5, F.concat(_fixed2(x / 1e5), F.lit(" L")))
             .when(size >= 1e3, F.concat(F.call_function("format_number", x / 1e3, F.lit("0.0")), F.lit(" K")))
             .otherwise(F.call_function("format_number", x, F.lit("0"))))


def _ordinary(x: Column) -> Column:
    size = F.abs(x)
    return (size == 0) | ((size >= 1e-4) & (size < 1e17))


def money_parts(c: Column | str) -> tuple[Column, Column]:
    """Two aggregates whose parts add up and merge: the exact sum of ordinary amounts as
    DECIMAL(38,10), and the plain sum of all others (infinite, from 1e17 on, or below 1e-4 but not 0),
    which that type cannot hold. NaN counts as missing."""
    x = _col(c).cast("double")
    ordinary = _ordinary(x)
    return (F.sum(F.when(ordinary, x.cast(MONEY_DECIMAL))),
            F.sum(F.when(~ordinary & ~F.isnan(x), x)))


def money_limbs(c: Column | str) -> tuple[tuple[Column, Column, Column], Column]:
    """:func:`money_parts` before the sums, for aggregations that repeat their rows: an ordinary
    amount as DECIMAL(38,10) has it, in units of 1e-10, as three BIGINT digits to the base 1e9 (the lowest first,
    all with the amount's sign), and the other amounts. Sums of BIGINTs cost a fraction of sums of
    wide decimals; they hold 9e9 rows. :func:`money_of_limbs` puts the sums together."""
    x = _col(c).cast("double")
    unit = F.lit(10 ** 10).cast("decimal(11,0)")
    near = F.abs(x) < 99999999.0                                        # nine digits of units fit twice
    low = F.when(near, (F.when(near, x).cast("decimal(18,10)") * unit).cast("long"))
    wide = F.when(~near & _ordinary(x), x).cast("decimal(28,10)")
    whole = wide.cast("long")                                           # cut towards zero
    rest = ((wide - whole.cast("decimal(18,0)")).cast("decimal(11,10)") * unit).cast("long")
    low = F.when(_ordinary(x), F.coalesce(low, whole % (10 ** 8) * (10 ** 10) + rest))
    high = F.when(_ordinary(x), F.when(near, F.lit(0).cast("long")).otherwise(F.call_function("div", whole, F.lit(10 ** 8))))
    return ((low % (10 ** 9), F.call_function("div", low, F.lit(10 ** 9)), high),
            F.when(~_ordinary(x) & ~F.isnan(x), x))


def money_of_limbs(low: Column, middle: Column, high: Column) -> Column:
    """The exact sum as DECIMAL(38,10) from the sums of the three digits of :func:`money_limbs`."""
    # room for two carries: a wider type would give up decimals in the addition
    places = ((low, "0.0000000001", "decimal(10,10)"), (middle, "0.1", "decimal(1,1)"), (high, "100000000", "decimal(9,0)"))
    parts = [(limb.cast("decimal(19,0)") * F.lit(value).cast(kind)).cast("decimal(36,10)") for limb, value, kind in places]
    whole = (parts[0] + parts[1] + parts[2]).cast(MONEY_DECIMAL)
    # nearly all sums fit one BIGINT of units: one decimal operation instead of eleven
    small = (high == 0) & (F.abs(middle) < 10 ** 8) & (F.abs(low) < 10 ** 17)
    units = F.when(small, middle * 10 ** 9 + low).cast("decimal(18,0)")
    return F.coalesce((units * F.lit("0.0000000001").cast("decimal(10,10)")).cast(MONEY_DECIMAL), whole)


def money_total(exact: Column, odd: Column) -> Column:
    """The amount that :func:`money_parts` stand for, as DOUBLE; NULL when there was none."""
    exact = exact.cast("double")
    return F.when(odd.isNull(), exact).otherwise(odd + F.coalesce(exact, F.lit(0.0)))


def money_sum(c: Column | str) -> Column:
    """Exact sum of amounts: each ordinary value is cast to DECIMAL(38,10) and
    summed without rounding error, so the total does not depend on
    partitioning, merge order or task retries; returned as DOUBLE like the
    amounts themselves. Infinite, huge and tiny amounts are added plainly, NaN is missing."""
    return money_total(*money_parts(c))


def money_avg(c: Column | str) -> Column:
    """Mean amount from the exact sum and the count of amounts present
    (NULL for an empty group), so it is as deterministic as ``money_sum``."""
    return money_sum(c) / F.count(F.nanvl(_col(c).cast("double"), F.lit(None)))
