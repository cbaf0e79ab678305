"""Schemas and fixed vocabularies.

Everything under "FIXED VALUES" must equal the source application's values for
cleaning results to agree; it is stated plainly and in its natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------- #
# FIXED VALUES (must match the source application's cleaning rules)
# --------------------------------------------------------------------------- #

# Accepted date formats, tried in this order (first success wins).
# Spark patterns; one-digit day/month are accepted like the original parser
# (d, M: 1-2 digits; yyyy: 4 digits; yy: 2 digits).
DATE_FORMATS: list[str] = ["yyyy-M-d", "d/M/yyyy", "d-M-yy", "M/d/yyyy", "d/M/yy"]
# Two-digit years (yy) pivot like Python's %y: 69..99 -> 19xx, 00..68 -> 20xx.
DEFAULT_DATE_WINDOW: tuple[str, str] = ("2015-01-01", "2025-12-31")

CITY_CANONICAL: dict[str, str] = {
    "bangalore": "Bengaluru", "banglore": "Bengaluru", "bengaluru": "Bengaluru",
    "bombay": "Mumbai", "mumbai": "Mumbai",
    "new delhi": "Delhi", "delhi": "Delhi",
    "calcutta": "Kolkata", "kolkata": "Kolkata",
    "madras": "Chennai", "chennai": "Chennai",
}

TRUE_TOKENS: list[str] = ["true", "yes", "y", "1", "1.0"]
BOOLEAN_COLUMNS: tuple[str, ...] = ("is_prime_member", "is_prime_eligible", "is_festival_sale")

CATEGORY_CANONICAL: dict[str, str] = {
    "electronic": "Electronics", "electronics": "Electronics",
    "electronics & accessories": "Electronics",
    "apparel": "Fashion", "fashion": "Fashion",
    "home and kitchen": "Home & Kitchen", "home & kitchen": "Home & Kitchen",
}

PAYMENT_CANONICAL: dict[str, str] = {
    "phonepe": "UPI", "googlepay": "UPI", "paytm upi": "UPI", "upi": "UPI",
    "credit_card": "Credit Card", "cc": "Credit Card", "credit card": "Credit Card",
    "cod": "Cash on Delivery", "c.o.d": "Cash on Delivery",
    "cash on delivery": "Cash on Delivery",
    "netbanking": "Net Banking", "net banking": "Net Banking",
    "debit card": "Debit Card", "emi": "EMI", "wallet": "Wallet",
}
UNKNOWN_PAYMENT = "Unknown"

# Messy variants used by defect injection (canonical -> variants).
CITY_VARIANTS: dict[str, list[str]] = {
    "Bengaluru": ["Bangalore", "bengaluru", "BENGALURU", "Banglore"],
    "Mumbai": ["Bombay", "mumbai", "MUMBAI"],
    "Delhi": ["New Delhi", "delhi", "NEW DELHI"],
    "Kolkata": ["Calcutta", "kolkata"],
    "Chennai": ["Madras", "chennai"],
}
CATEGORY_VARIANTS: dict[str, list[str]] = {
    "Electronics": ["Electronic", "ELECTRONICS", "Electronics & Accessories", "electronics"],
    "Fashion": ["fashion", "FASHION", "Apparel"],
    "Home & Kitchen": ["Home and Kitchen", "home & kitchen", "HOME & KITCHEN"],
}
PAYMENT_VARIANTS: dict[str, list[str]] = {
    "UPI": ["PhonePe", "GooglePay", "upi", "Paytm UPI"],
    "Credit Card": ["CREDIT_CARD", "CC", "credit card"],
    "Cash on Delivery": ["COD", "C.O.D", "cash on delivery"],
    "Net Banking": ["NetBanking", "net banking", "NETBANKING"],
}

CATEGORIES: list[str] = [
    "Electronics", "Fashion", "Home & Kitchen", "Books",
    "Beauty", "Sports", "Toys", "Grocery",
]
PAYMENT_METHODS: list[str] = [
    "UPI", "Credit Card", "Debit Card", "Net Banking",
    "Cash on Delivery", "EMI", "Wallet",
]

# city -> (state, tier)
CITY_TIERS: dict[str, tuple[str, str]] = {
    "Mumbai": ("Maharashtra", "Metro"),
    "Delhi": ("Delhi", "Metro"),
    "Bengaluru": ("Karnataka", "Metro"),
    "Chennai": ("Tamil Nadu", "Metro"),
    "Kolkata": ("West Bengal", "Metro"),
    "Hyderabad": ("Telangana", "Metro"),
    "Pune": ("Maharashtra", "Tier1"),
    "Ahmedabad": ("Gujarat", "Tier1"),
    "Jaipur": ("Rajasthan", "Tier1"),
    "Lucknow": ("Uttar Pradesh", "Tier1"),
    "Surat": ("Gujarat", "Tier1"),
    "Indore": ("Madhya Pradesh", "Tier2"),
    "Bhopal": ("Madhya Pradesh", "Tier2"),
    "Nagpur": ("Maharashtra", "Tier2"),
    "Coimbatore": ("Tamil Nadu", "Tier2"),
    "Kochi": ("Kerala", "Tier2"),
    "Guwahati": ("Assam", "Tier2"),
    "Patna": ("Bihar", "Tier2"),
    "Ranchi": ("Jharkhand", "Rural"),
    "Udaipur": ("Rajasthan", "Rural"),
    "Shimla": ("Himachal Pradesh", "Rural"),
}

# Right-closed discount bands: (lower exclusive, upper inclusive, label).
DISCOUNT_BANDS: list[tuple[float, float, str]] = [
    (-1, 0, "0%"), (0, 10, "1-10%"), (10, 20, "11-20%"), (20, 30, "21-30%"), (30, 100, "30%+"),
]

# Tokens the original CSV reader treats as missing.
NA_TOKENS: list[str] = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

OUTLIER_FACTOR = 50.0   # price > factor * category median is a decimal error
OUTLIER_DIVISOR = 100.0
MAX_DELIVERY_DAYS = 15
RAW_FILE_GLOB = "*_2*.csv"
# Amounts are summed exactly as this type (see functions.money_sum).
MONEY_DECIMAL = "decimal(38,10)"

# --------------------------------------------------------------------------- #
# Schemas
# --------------------------------------------------------------------------- #

_S, _D, _I, _B, _DT, _L = T.StringType(), T.DoubleType(), T.IntegerType(), T.BooleanType(), T.DateType(), T.LongType()

CLEAN_SCHEMA = T.StructType([
    T.StructField("transaction_id", _S), T.StructField("customer_id", _S),
    T.StructField("product_id", _S), T.StructField("product_name", _S),
    T.StructField("category", _S), T.StructField("subcategory", _S), T.StructField("brand", _S),
    T.StructField("product_rating", _D), T.StructField("order_date", _DT),
    T.StructField("order_year", _I), T.StructField("order_month", _I),
    T.StructField("order_quarter", _I), T.StructField("original_price_inr", _D),
    T.StructField("discount_percent", _D), T.StructField("final_amount_inr", _D),
    T.StructField("delivery_charges", _D), T.StructField("customer_city", _S),
    T.StructField("customer_state", _S), T.StructField("customer_tier", _S),
    T.StructField("age_group", _S), T.StructField("is_prime_member", _B),
    T.StructField("payment_method", _S), T.StructField("delivery_days", _D),
    T.StructField("return_status", _S), T.StructField("customer_rating", _D),
    T.StructField("is_festival_sale", _B), T.StructField("festival_name", _S),
    T.StructField("customer_spending_tier", _S),
])

PRODUCTS_SCHEMA = T.StructType([
    T.StructField("product_id", _S), T.StructField("product_name", _S),
    T.StructField("category", _S), T.StructField("subcategory", _S),
    T.StructField("brand", _S), T.StructField("product_rating", _D),
])
CUSTOMERS_SCHEMA = T.StructType([
    T.StructField("customer_id", _S), T.StructField("customer_city", _S),
    T.StructField("customer_state", _S), T.StructField("customer_tier", _S),
    T.StructField("age_group", _S), T.StructField("is_prime_member", _B),
    T.StructField("total_orders", _L), T.StructField("total_spend", _D),
])
TIME_SCHEMA = T.StructType([
    T.StructField("order_date", _DT), T.StructField("year", _I), T.StructField("quarter", _I),
    T.StructField("month", _I), T.StructField("month_name", _S), T.StructField("day_of_week", _S),
])

TABLE_SCHEMAS: dict[str, T.StructType] = {
    "transactions": CLEAN_SCHEMA, "products": PRODUCTS_SCHEMA,
    "customers": CUSTOMERS_SCHEMA, "time_dimension": TIME_SCHEMA,
}

# Primary keys of the warehouse tables (Spark does not enforce them).
PRIMARY_KEYS: dict[str, list[str]] = {
    "transactions": ["transaction_id"],
    "products": ["product_id"],
    "customers": ["customer_id"],
    "time_dimension": ["order_date"],
}
# Declared (documented, not enforced) foreign keys: fact column -> (table, column).
FOREIGN_KEYS: dict[str, tuple[str, str]] = {
    "product_id": ("products", "product_id"),
    "customer_id": ("customers", "customer_id"),
}
