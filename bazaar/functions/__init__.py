"""Column -> Column expressions. All are built-in Spark SQL functions so they
stay inside whole-stage code generation; none is a Python UDF."""

from bazaar.functions.text import strip_ws, title_case, canonical_lookup
from bazaar.functions.parse import (
    parse_date, parse_price, parse_rating, parse_delivery_days, to_bool,
)
from bazaar.functions.fmt import (
    discount_band, format_inr, flag_label, human_int, money_avg, money_limbs, money_of_limbs, money_parts, money_sum,
    money_total, period_label,
)

__all__ = [
    "strip_ws", "title_case", "canonical_lookup",
    "parse_date", "parse_price", "parse_rating", "parse_delivery_days", "to_bool",
    "discount_band", "format_inr", "flag_label", "human_int", "period_label",
    "money_avg", "money_limbs", "money_of_limbs", "money_parts", "money_sum", "money_total",
]
