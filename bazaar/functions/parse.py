"""Parsers for the messy text columns. NULL in, NULL out unless stated.

Every parser is a composition of built-in functions: ``try_*`` variants keep
ANSI mode from raising on bad input, so a bad cell becomes NULL exactly like a
coerced parse failure.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from bazaar.schema import DATE_FORMATS, DEFAULT_DATE_WINDOW, MAX_DELIVERY_DAYS, TRUE_TOKENS
from bazaar.functions.text import _col, strip_ws


def _shape(fmt: str) -> tuple[str, dict[str, int]]:
    """Regex with one group per field of ``fmt`` and the group index of each
    field ('yyyy'/'yy' 4 or 2 digits, 'd'/'M' 1 or 2 digits)."""
    parts = re.split(r"([-/])", fmt)
    groups: dict[str, int] = {}
    rx = ""
    for part in parts:
        if part in ("-", "/"):
            rx += part
            continue
        groups[part] = len(groups) + 1
        rx += {"yyyy": "([0-9]{4})", "yy": "([0-9]{2})"}.get(part, "([0-9]{1,2})")
    return f"^{rx}$", groups


def _to_iso(s: Column, fmt: str) -> Column:
    """Rewrite text in the shape of ``fmt`` to 'y-M-d' text (other text is
    left as it is). A two-digit year 69..99 becomes 19xx, 00..68 20xx, as
    Python's %y does (Spark's yy would give 20xx for all)."""
    rx, g = _shape(fmt)
    md = f"-${g['M']}-${g['d']}"
    if "yyyy" in g:
        return F.regexp_replace(s, rx, f"${g['yyyy']}{md}")
    late = rx.replace("([0-9]{2})", "(69|[7-9][0-9])")
    s = F.regexp_replace(s, late, f"19${g['yy']}{md}")
    return F.regexp_replace(s, rx, f"20${g['yy']}{md}")


# Year 0000 is no year for Python's %Y (Spark would read it as 1 BC).
_ISO_SHAPE = r"^(?!0000-)[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"


def parse_date(c: Column | str, window: tuple[str, str] | None = DEFAULT_DATE_WINDOW,
               formats: list[str] | None = None) -> Column:
    """Try each format in order, keep the first success, then blank out dates
    outside the inclusive ``window`` (no retry with a later format).

    Formats with different shapes can never both match, so one pass of
    rewrites turns the first format of every shape into ISO text and a single
    guarded formatter call parses it; only a shape shared by two formats
    (d/M/yyyy, then M/d/yyyy) gets a second candidate. Each parse runs only on
    text of the right shape, so the formatter never sees junk.
    """
    s = strip_ws(c)
    ranks: list[list[str]] = []
    for fmt in formats or DATE_FORMATS:
        shape = _shape(fmt)[0]
        rank = sum(_shape(f)[0] == shape for r in ranks for f in r)
        if rank == len(ranks):
            ranks.append([])
        ranks[rank].append(fmt)
    candidates = []
    for i, rank in enumerate(ranks):
        text = s
        for fmt in rank:
            text = _to_iso(text, fmt)
        cand = F.when(text.rlike(_ISO_SHAPE), F.try_to_date(text, "yyyy-M-d"))
        if i:
            shapes = "|".join(f"(?:{_shape(f)[0]})" for f in rank)
            cand = F.when(s.rlike(shapes), cand)
        candidates.append(cand)
    parsed = F.coalesce(*candidates) if len(candidates) > 1 else candidates[0]
    if window is None:
        return parsed
    lo, hi = window
    return F.when(parsed.between(F.lit(lo).cast("date"), F.lit(hi).cast("date")), parsed)


def parse_price(c: Column | str) -> Column:
    """'₹1,25,000' -> 125000.0; 'Price on Request', blanks, junk -> NULL.

    Every character other than digits and '.' is dropped before the cast, so a
    sign or exponent disappears ('-5' -> 5, '9e6' -> 96)."""
    s = strip_ws(c)
    digits = F.regexp_replace(s, r"[^0-9.]", "")
    bad = (s == "") | F.lower(s).contains("request")
    return F.when(_col(c).isNull() | bad, F.lit(None).cast("double")) \
        .otherwise(digits.try_cast("double"))


def parse_rating(c: Column | str) -> Column:
    """'4 stars', '3/5', '2.5/5.0', '4.5' -> leading number, rounded half-even
    to a 0.5 step, clamped to [1, 5]. Unparseable -> NULL (never clamped)."""
    s = strip_ws(F.lower(_col(c).cast("string")))
    num = F.regexp_extract(s, r"^([0-9.]+)", 1).try_cast("double")
    stepped = F.bround(num * 2, 0) / 2
    return F.when(num.isNotNull(), F.least(F.lit(5.0), F.greatest(F.lit(1.0), stepped)))


def parse_delivery_days(c: Column | str, negatives: str = "abs",
                        decimals: bool = False, max_days: int = MAX_DELIVERY_DAYS) -> Column:
    """'Same Day' -> 0; otherwise the mean of all numbers in the text
    ('1-2 days' -> 1.5); a mean above ``max_days`` -> NULL.

    negatives="abs" keeps the source behaviour ('-2' -> 2, the sign is not a
    digit); negatives="null" drops texts that start with a minus sign.
    decimals=False keeps the source behaviour ('5.0' -> mean(5, 0) = 2.5);
    decimals=True reads '5.0' as one number.
    """
    s = F.lower(strip_ws(c))
    num = r"([0-9]+(?:\.[0-9]+)?)" if decimals else r"([0-9]+)"
    gap = r"[^0-9]" if not decimals else r"(?:[^0-9.]|\.(?![0-9]))"
    # Fast paths without a lambda: one number, or exactly two numbers.
    one = rf"^{gap}*{num}{gap}*$"
    two = rf"^{gap}*{num}{gap}+{num}{gap}*$"
    nums = F.regexp_extract_all(s, F.lit(num), F.lit(1))
    total = F.aggregate(nums, F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    general = F.when(F.size(nums) > 0, F.try_divide(total, F.size(nums).cast("double")))
    val = (F.when(s.rlike(one), F.regexp_extract(s, one, 1).cast("double"))
            .when(s.rlike(two), (F.regexp_extract(s, two, 1).cast("double")
                                 + F.regexp_extract(s, two, 2).cast("double")) / 2)
            .otherwise(general))
    val = F.when(val <= max_days, val)
    if negatives == "null":
        val = F.when(~s.rlike(r"^-\s*[0-9]"), val)
    elif negatives != "abs":
        raise ValueError("negatives must be 'abs' or 'null'")
    return F.when(_col(c).isNull(), F.lit(None).cast("double")) \
        .when(s.contains("same day"), F.lit(0.0)) \
        .otherwise(val)


def to_bool(c: Column | str) -> Column:
    """True tokens -> true; everything else, missing included -> false."""
    return F.coalesce(F.lower(strip_ws(c)).isin(*TRUE_TOKENS), F.lit(False))
