"""Joining a fact with a per-key table computed from it (group medians,
box-plot fences, ...).

Catalyst cannot know how small such a table is: its size estimate is the
fact's, so the static plan is a sort-merge join that shuffles the whole fact
on the key. With few keys (eight categories) that shuffle funnels the fact
into a handful of reducers, and AQE only learns the table is tiny after the
fact's shuffle write has started.

``lookup_join`` therefore writes the per-key table once (a lineage cut under
the shared checkpoint folder), measures its in-memory size with one small
aggregate, and broadcasts it only when that measured size is under
``spark.sql.autoBroadcastJoinThreshold``. Beyond the bound it is a shuffle
join on the key, where AQE splits a skewed key partition; when the session
has skew joins off, the key is salted explicitly (``salted_join``).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from bazaar.sources.scratch import materialize

_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
          "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}
# UnsafeRow: a null bitmap word per row plus 8 bytes per field; variable-length
# values add their bytes. The hashed relation adds about as much again.
_ROW_OVERHEAD = 8
_RELATION_FACTOR = 2


def parse_bytes(text: str) -> int:
    """'10485760b' / '10MB' / '-1' -> bytes (-1 means disabled)."""
    m = re.fullmatch(r"\s*(-?[0-9]+)\s*([a-zA-Z]*)\s*", str(text))
    if not m:
        raise ValueError(f"not a byte size: {text!r}")
    n = int(m.group(1))
    return n if n < 0 else n * _UNITS[m.group(2).lower()]


def broadcast_threshold(spark) -> int:
    return parse_bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10MB"))


def measured_bytes(df: DataFrame) -> int:
    """In-memory size of ``df`` as broadcast rows: one aggregate over it."""
    fields = df.schema.fields
    var = [f.name for f in fields if isinstance(f.dataType, (StringType, BinaryType))]
    var_bytes = [F.coalesce(F.sum(F.octet_length(F.col(c))), F.lit(0)) for c in var]
    row = df.agg(F.count(F.lit(1)).alias("n"),
                 (sum(var_bytes[1:], var_bytes[0]) if var_bytes else F.lit(0)).alias("v")).first()
    fixed = _ROW_OVERHEAD + 8 * len(fields)
    return (row["n"] * fixed + int(row["v"])) * _RELATION_FACTOR


def _skew_join_on(spark) -> bool:
    conf = spark.conf
    return (conf.get("spark.sql.adaptive.enabled", "true").lower() == "true"
            and conf.get("spark.sql.adaptive.skewJoin.enabled", "true").lower() == "true")


def salted_join(fact: DataFrame, lookup: DataFrame, on: list[str], how: str, salt: int) -> DataFrame:
    """Equi-join that spreads every key over ``salt`` partitions: each fact
    row gets a salt from a hash of its own values (deterministic under task
    retries) and the lookup is replicated once per salt value, so a key
    holding a third of the fact is split ``salt`` ways. Every fact row meets
    exactly one copy of its lookup row, so inner and left joins are exact."""
    salted = fact.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in fact.columns]), F.lit(salt)))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1)).cast("array<bigint>")))
    return salted.join(copies, on + ["_salt"], how).drop("_salt")


def lookup_join(fact: DataFrame, lookup: DataFrame, on: list[str] | str, how: str = "left",
                max_bytes: int | None = None, label: str = "lookup",
                written: bool = False, salt: int | None = None) -> DataFrame:
    """``fact.join(lookup, on, how)`` with a size-checked broadcast of ``lookup``.

    Beyond the bound it is a shuffle join: AQE splits a skewed key partition
    when skew joins are enabled; otherwise (or when ``salt`` is given) the
    key is salted explicitly. ``written=True`` says ``lookup`` already reads
    a written table, so it is not written again."""
    if how not in ("left", "inner"):
        raise ValueError("lookup_join supports 'left' and 'inner' joins")
    keys = [on] if isinstance(on, str) else list(on)
    small = lookup if written else materialize(lookup, label)
    bound = broadcast_threshold(fact.sparkSession) if max_bytes is None else max_bytes
    if bound >= 0 and measured_bytes(small) <= bound:
        return fact.join(F.broadcast(small), keys, how)
    if salt is None and _skew_join_on(fact.sparkSession):
        return fact.join(small, keys, how)
    return salted_join(fact, small, keys, how, salt or 16)
