"""Oracle-side (DuckDB) text of the views the queries read."""

from __future__ import annotations

from bazaar.sources.tables import SALES_SQL

#: The dashboard filter of the filtered report queries.
FILTER_YEARS = (1996, 1999)
FILTER_CATEGORIES = ["LARGE", "PROMO", "SMALL", "STANDARD"]
FILTER_TIERS = ["AMERICA", "ASIA", "EUROPE"]
FILTER_SQL = """order_year between 1996 and 1999
  and category in ('LARGE', 'PROMO', 'SMALL', 'STANDARD')
  and customer_tier in ('AMERICA', 'ASIA', 'EUROPE')"""


def cte_prefix(ctes: tuple[str, ...]) -> str:
    from bazaar.operators.inject import MESSY_SQL, RAW_SQL
    texts = {"sales": SALES_SQL, "messy": MESSY_SQL, "raw": RAW_SQL}
    needed = list(ctes)
    if "raw" in needed and "messy" not in needed:
        needed.insert(0, "messy")
    if not needed:
        return ""
    if needed == ["filtered sales"]:
        return f"with sales as (select * from ({SALES_SQL}) s where {FILTER_SQL})\n"
    return "with " + ",\n".join(f"{c} as ({texts[c]})" for c in needed) + "\n"
