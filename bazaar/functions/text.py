"""String helpers with Python-string semantics, as native Spark expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.strip() removes, derived from str.isspace();
# Spark's trim(str, chars) strips exactly these without a regex.
_PY_WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
# A letter that follows a character which is neither a letter nor a space
# starts a new word for Python's str.title(); initcap only splits on spaces.
_WORD_BREAK = r"(?<=[^\p{L} ])(?=\p{L})"
_MARK = "\u0001 "


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: Column | str) -> Column:
    """``str.strip()``: remove leading/trailing whitespace of any kind."""
    return F.trim(_col(c).cast("string"), F.lit(_PY_WHITESPACE))


def title_case(c: Column | str) -> Column:
    """``str.title()``: upper-case the first letter of every run of letters.

    A temporary "\\u0001 " marker makes each letter-run after a non-letter a
    separate word for ``initcap``; the marker is removed afterwards.
    """
    marked = F.regexp_replace(_col(c), _WORD_BREAK, _MARK)
    return F.regexp_replace(F.initcap(marked), _MARK, "")


def literal_map(mapping: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def canonical_lookup(c: Column | str, mapping: dict[str, str],
                     null_value: str | None = None) -> Column:
    """Alias map on ``lower(strip(v))``, else ``strip(v).title()``.

    NULL input gives ``null_value`` (NULL by default).
    """
    stripped = strip_ws(c)
    hit = F.try_element_at(literal_map(mapping), F.lower(stripped))
    fixed = F.coalesce(hit, title_case(stripped))
    fallback = F.lit(null_value) if null_value is not None else F.lit(None).cast("string")
    return F.when(_col(c).isNull(), fallback).otherwise(fixed)
