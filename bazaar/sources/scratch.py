"""Lineage cuts: write an intermediate result as Parquet under the shared
checkpoint folder (``spark.checkpoint.dir``) and read it back.

This survives executor loss (the files live on the shared file system, not
in executor memory) and, unlike ``Dataset.checkpoint``, stores columnar
compressed data that later reads can prune and filter.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from bazaar.session import ensure_checkpoint_dir

_OWNED: ContextVar[list[str] | None] = ContextVar("owned", default=None)


@contextmanager
def owned(spark: SparkSession):
    """Intermediates written inside the block are deleted at its end, so results
    must be written out within it. Threads join by running in a copy of the context."""
    paths: list[str] = []
    token = _OWNED.set(paths)
    try:
        yield
    finally:
        _OWNED.reset(token)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in paths:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the checkpoint folder, deleted at the end of an :func:`owned` block."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/bazaar-{label}-{uuid.uuid4().hex}"
    paths = _OWNED.get()
    if paths is not None:
        paths.append(path)
    return path


def materialize(df: DataFrame, label: str, partition_by: list[str] | None = None, codec: str | None = None) -> DataFrame:
    """Writes ``df`` and reads it back. ``codec`` replaces the session's Parquet codec, for rows of a whole fact."""
    path = scratch_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path, partitionBy=partition_by, compression=codec)
    return df.sparkSession.read.parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Give CPU-heavy row-wise work at least one task per core.

    Only when the input has fewer partitions than the default parallelism
    (a few small files) is it redistributed; a large input already has many
    splits and passes through untouched, with no extra shuffle.

    Meant for freshly read inputs (scans, filters, projections, unions): on
    a plan that already shuffles, counting its partitions would run the
    shuffle stages once before the real job (AQE plans them eagerly).
    """
    try:
        want = df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - sessions without an RDD API: leave as is
        return df
    if have >= want:
        return df
    return df.repartition(want)
