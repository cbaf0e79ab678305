"""Keep-first de-duplication over several loads.

Each load appends the rows that are new, and the rows that come before what an earlier load kept for
their id; those are listed as replaced. What was kept before is not written again: a load reads
the ids and order keys of it, and the table is all loads' rows without the replaced
ones. The result is that of one load over everything, in whatever order the files arrive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.operators.clean import dedup_keep_first
from bazaar.operators.joins import lookup_join
from bazaar.sources.versions import Versions

_LOAD = "_load"


class KeepFirst:
    """The kept rows of one table under ``location``. ``order`` decides which row of an id is the
    first and must tell rows of one id apart (file and line do); a NULL id is one id."""

    def __init__(self, spark: SparkSession, location: str, key: str, order: list[str]) -> None:
        self.spark, self.key, self.order = spark, key, order
        self.versions = Versions(spark, location)

    def loads(self) -> list[str]:
        """The loads that make up the table; ``tables`` of the valid manifest."""
        manifest = self.versions.current()
        return manifest["tables"] if manifest else []

    def _union(self, loads: list[str], part: str) -> DataFrame:
        return self.spark.read.parquet(*[self.versions.folder(x, part) for x in loads])

    def rows(self) -> DataFrame | None:
        """The kept rows with the load that brought them, or None before the first load."""
        loads = self.loads()
        if not loads:
            return None
        gone = self._union(loads, "replaced").select(F.col(self.key).alias("_gone"), F.col(_LOAD).alias("_gone_load"),
                                                     F.lit(True).alias("_is_gone"))
        kept = self._union(loads, "rows").withColumn("_gone", F.col(self.key)).withColumn("_gone_load", F.col(_LOAD))
        # an id is replaced at most once per load; a NULL id joins through a marker of its own
        mark = F.coalesce(F.col("_gone").cast("string"), F.lit("")), F.col("_gone").isNull()
        kept, gone = (x.withColumn("_text", mark[0]).withColumn("_null", mark[1]).drop("_gone") for x in (kept, gone))
        on = ["_text", "_null", "_gone_load"]
        return lookup_join(kept, gone, on, "left", label="replaced").where("_is_gone is null").drop(*on, "_is_gone")

    def table(self) -> DataFrame | None:
        rows = self.rows()
        return None if rows is None else rows.drop(_LOAD)

    def load(self, batch: DataFrame) -> str:
        """Adds the rows of ``batch``; returns the load's name. A load that fails changes nothing."""
        load = self.versions.stage()
        first = dedup_keep_first(batch, self.key, self.order)
        before = self.rows()
        place = F.struct(*[F.col(c) for c in self.order])
        if before is None:
            fresh = first.withColumn("_old", F.lit(None).cast("string"))
        else:
            seen = before.select(F.col(self.key).alias("_id"), place.alias("_at"), F.col(_LOAD).alias("_old"))
            fresh = first.join(seen, F.col(self.key).eqNullSafe(F.col("_id")), "left") \
                .where(F.col("_old").isNull() | (place < F.col("_at"))).drop("_id", "_at")
        folder = self.versions.folder(load, "staged")
        fresh.write.parquet(folder)             # both parts below come from these rows
        fresh = self.spark.read.parquet(folder)
        fresh.where("_old is not null").select(self.key, F.col("_old").alias(_LOAD)).write.parquet(self.versions.folder(load, "replaced"))
        fresh.drop("_old").withColumn(_LOAD, F.lit(load)).write.parquet(self.versions.folder(load, "rows"))
        self.versions.commit(load, [*self.loads(), load])
        return load
