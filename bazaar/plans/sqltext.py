"""DuckDB-dialect text of the cleaning expressions, written independently of
the Spark versions (used only by oracle queries)."""

from __future__ import annotations

from bazaar.schema import TRUE_TOKENS


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace(cast({x} as varchar), '^\\s+|\\s+$', '', 'g')"


def title(s: str) -> str:
    return (f"array_to_string([case when i = 1 or not regexp_matches(substr({s}, i - 1, 1), '\\p{{L}}') "
            f"then upper(substr({s}, i, 1)) else lower(substr({s}, i, 1)) end "
            f"for i in range(1, length({s}) + 1)], '')")


def lookup(x: str, mapping: dict[str, str], null_value: str | None = None) -> str:
    s = strip(x)
    cases = " ".join(f"when {q(k)} then {q(v)}" for k, v in mapping.items())
    fallback = q(null_value) if null_value is not None else "null"
    return f"(case when {x} is null then {fallback} else (case lower({s}) {cases} else {title(s)} end) end)"


_DATE_GUARDS = [
    ("^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$", "%Y-%m-%d"),
    ("^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "%d/%m/%Y"),
    ("^[0-9]{1,2}-[0-9]{1,2}-[0-9]{2}$", "%d-%m-%y"),
    ("^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "%m/%d/%Y"),
    ("^[0-9]{1,2}/[0-9]{1,2}/[0-9]{2}$", "%d/%m/%y"),
]


def parse_date(x: str, lo: str, hi: str) -> str:
    s = strip(x)
    tries = ", ".join(f"case when regexp_matches({s}, '{rx}') then cast(try_strptime({s}, '{fmt}') as date) end"
                      for rx, fmt in _DATE_GUARDS)
    d = f"coalesce({tries})"
    return f"(case when {d} between date '{lo}' and date '{hi}' then {d} end)"


def parse_price(x: str) -> str:
    s = strip(x)
    return (f"(case when {x} is null or {s} = '' or contains(lower({s}), 'request') then null "
            f"else try_cast(regexp_replace({s}, '[^0-9.]', '', 'g') as double) end)")


def parse_rating(x: str) -> str:
    s = strip(f"lower({x})")
    num = f"try_cast(regexp_extract({s}, '^([0-9.]+)', 1) as double)"
    return f"(case when {num} is not null then least(5.0, greatest(1.0, round_even({num} * 2, 0) / 2)) end)"


def to_bool(x: str) -> str:
    toks = ", ".join(q(t) for t in TRUE_TOKENS)
    return f"coalesce(lower({strip(x)}) in ({toks}), false)"


def parse_delivery(x: str) -> str:
    s = f"lower({strip(x)})"
    nums = f"regexp_extract_all({s}, '([0-9]+)', 1)"
    mean = f"(list_sum(list_transform({nums}, lambda n: cast(n as double))) / len({nums}))"
    return (f"(case when {x} is null then null when contains({s}, 'same day') then 0.0 "
            f"when len({nums}) = 0 then null when {mean} <= 15 then {mean} end)")
