"""Shared helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.sources.scratch import materialize

__all__ = ["documents", "fold", "map_arrow", "materialize", "with_defaults"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fold(doc_id: str | Column, buckets: int) -> Column:
    """crc32 of the id's decimal text, modulo ``buckets`` (a NULL id counts as empty text)."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(col.cast("string"), F.lit(""))) % buckets


def with_defaults(docs: DataFrame, *cols: str) -> DataFrame:
    """Only the named columns, so that extra columns can clash with nothing."""
    return docs.select(*[F.col(f"`{c}`") for c in cols])


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    """``mapInArrow`` for a function of one batch."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)
    return df.mapInArrow(run, schema)
