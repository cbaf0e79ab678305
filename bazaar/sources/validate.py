"""A sink that checks rows while it writes them: good rows and a quarantine, in one pass.

Spark enforces no keys, vocabularies or ranges. Here every row gets the names of the rules it
breaks, and the rows are written once, parted by whether there are any; readers see
the good rows, and the quarantine keeps the others with their reasons. Key rules need a small
table of suspect keys first: one aggregation over the key columns only.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.operators.joins import lookup_join
from bazaar.sources.scratch import materialize
from bazaar.sources.versions import Versions

_ROW, _BROKEN = "_row", "_broken"


@dataclass(frozen=True)
class Rules:
    """What rows must satisfy; the rules' names are those of the counts.

    ``checks``: conditions by name (NULL counts as broken); ``vocabularies``: column -> allowed values
    (NULL passes); ``types``: text column -> type it must cast to (NULL passes); ``unique``: name -> key
    columns, of which the first row in ``order`` is good (a NULL key is broken); ``foreign``: column ->
    (parent, its key): every non-NULL value must be there.
    """

    checks: dict[str, Column] = field(default_factory=dict)
    vocabularies: dict[str, list] = field(default_factory=dict)
    types: dict[str, str] = field(default_factory=dict)
    unique: dict[str, list[str]] = field(default_factory=dict)
    foreign: dict[str, tuple[DataFrame, str]] = field(default_factory=dict)
    order: list[str] = field(default_factory=list)

    def row_rules(self) -> dict[str, Column]:
        """Broken-ness by rule name of the rules that one row decides."""
        out = {name: ~F.coalesce(cond, F.lit(False)) for name, cond in self.checks.items()}
        for c, allowed in self.vocabularies.items():
            out[f"{c} not in vocabulary"] = F.col(c).isNotNull() & ~F.col(c).isin(*allowed)
        for c, kind in self.types.items():
            out[f"{c} is no {kind}"] = F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull()
        return out


def judged(df: DataFrame, rules: Rules) -> DataFrame:
    """``df`` with ``_broken``, the sorted names of the rules that each row breaks.

    With a ``unique`` rule the rows are numbered and written first, so that rows which agree in all
    of ``order`` keep one first row, also when a task runs twice. Repeated keys and parents
    are joined as lookups: broadcast when their measured size allows it, else shuffled with
    AQE splitting a hot key. A key that a third of all rows hold is reduced in every task.
    """
    plain = df.columns
    broken = rules.row_rules()
    if rules.unique:
        df = materialize(df.withColumn(_ROW, F.monotonically_increasing_id()), "validate")
    for i, (name, keys) in enumerate(rules.unique.items()):
        place = F.struct(*[F.col(c) for c in rules.order], F.col(_ROW))
        repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(place).alias("_first")).where("_n > 1") \
            .select(*keys, F.col(f"_first.{_ROW}").alias(f"_first{i}"))
        df = lookup_join(df, repeated, keys, "left", label="repeated-keys")
        null_key = F.lit(False)
        for k in keys:
            null_key = null_key | F.col(k).isNull()
        broken[name] = null_key | (F.col(_ROW) != F.col(f"_first{i}"))
    for i, (c, (parent, key)) in enumerate(rules.foreign.items()):
        known = parent.where(F.col(key).isNotNull()).select(F.col(key).alias(c)).distinct().withColumn(f"_known{i}", F.lit(True))
        df = lookup_join(df, known, c, "left", label="parents")
        broken[f"{c} has no parent"] = F.col(c).isNotNull() & F.col(f"_known{i}").isNull()
    names = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in sorted(broken.items())]))
    return df.select(*[F.col(f"`{c}`") for c in plain], (names if broken else F.array().cast("array<string>")).alias(_BROKEN))


def write_validated(df: DataFrame, location: str, rules: Rules) -> DataFrame:
    """Writes good and broken rows as one new version of ``location``; returns :func:`rule_counts`."""
    versions = Versions(df.sparkSession, location)
    version = versions.stage()
    judged(df, rules).withColumn("_good", F.size(_BROKEN) == 0).write.partitionBy("_good") \
        .parquet(versions.folder(version, "rows"))
    versions.commit(version, ["rows"])
    return rule_counts(df.sparkSession, location)


def _rows(spark: SparkSession, location: str, good: bool) -> DataFrame:
    return Versions(spark, location).read("rows").where(F.col("_good") == good).drop("_good")


def good_rows(spark: SparkSession, location: str) -> DataFrame:
    return _rows(spark, location, True).drop(_BROKEN)


def quarantined(spark: SparkSession, location: str) -> DataFrame:
    """The rows kept out, with ``_broken``."""
    return _rows(spark, location, False)


def rule_counts(spark: SparkSession, location: str) -> DataFrame:
    """(rule, rows): broken rows by rule, and the totals ``good`` and ``quarantined``. The good rows
    are only counted (from the files' footers), the quarantine is read."""
    bad = quarantined(spark, location)
    return (good_rows(spark, location).agg(F.lit("good").alias("rule"), F.count(F.lit(1)).alias("rows"))
            .unionAll(bad.agg(F.lit("quarantined"), F.count(F.lit(1))))
            .unionAll(bad.select(F.explode(_BROKEN).alias("rule")).groupBy("rule").agg(F.count(F.lit(1)))))
