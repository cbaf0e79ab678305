"""A small registry: every query has a Spark builder, an optional oracle SQL
text (DuckDB dialect, over the driver's tables) and one rounding spec that is
applied to both sides so floating-point sums compare equal."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    name: str
    build: Builder
    oracle: str | None = None          # SQL body; may use the `sales` / `messy` CTEs
    rounding: dict[str, int] = field(default_factory=dict)
    ctes: tuple[str, ...] = ("sales",)

    def spark(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(spark, sf_dir)
        if not self.rounding:
            return df
        return df.select(*[F.round(F.col(c), self.rounding[c]).alias(c) if c in self.rounding
                           else F.col(c) for c in df.columns])

    def sql(self) -> str | None:
        if self.oracle is None:
            return None
        from bazaar.plans.oracle_views import cte_prefix
        body = self.oracle.strip()
        if self.rounding:
            repl = ", ".join(f"round({c}, {d}) as {c}" for c, d in self.rounding.items())
            body = f"select * replace ({repl}) from (\n{body}\n) q"
        else:
            body = f"select * from (\n{body}\n) q"
        return cte_prefix(self.ctes) + body


REGISTRY: dict[str, Query] = {}


def register(name: str, oracle: str | None = None, rounding: dict[str, int] | None = None,
             ctes: tuple[str, ...] = ("sales",)):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, oracle, dict(rounding or {}), ctes)
        return fn
    return deco
