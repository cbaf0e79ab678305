"""Raw CSV input, clean Parquet/CSV output and warehouse tables (IO1-IO11).

* Raw yearly files are read one by one with their own header and unioned
  **by name** (a positional multi-file read would silently swap columns
  when files disagree on column order). Every value stays a string; the
  usual missing-value tokens become NULL.
* Row order is kept explicitly as (_file, _line): the keep-first rules of
  the cleaning pipeline need it, and it does not depend on partitioning.
* The clean fact is written partitioned by ``order_year`` (year filters
  prune directories) and sorted within files by category and city.
* Every path goes through the Hadoop file system, so a path without a scheme
  means the same to the driver and to Spark's readers.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.schema import CLEAN_SCHEMA, NA_TOKENS, RAW_FILE_GLOB, TABLE_SCHEMAS
from bazaar.sources.layout import along_curve, bloom_options
from bazaar.sources.versions import Versions

ORDER_COLUMNS = ["_file", "_line"]
_BAD = "_bad_record"


def _hadoop(spark: SparkSession, path: str):
    """(Path, FileSystem) of a path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def raw_files(spark: SparkSession, source: str | list[str], pattern: str = RAW_FILE_GLOB) -> list[str]:
    if isinstance(source, list):
        return sorted(source)
    path, fs = _hadoop(spark, source.rstrip("/") + "/" + pattern)
    return sorted(str(s.getPath().toString()) for s in (fs.globStatus(path) or []))


def null_tokens(df: DataFrame, tokens: list[str] | None = None,
                skip: tuple[str, ...] = tuple(ORDER_COLUMNS)) -> DataFrame:
    """Turn the missing-value tokens into NULL in every string column."""
    toks = tokens if tokens is not None else NA_TOKENS
    return df.select(*[F.col(c) if c in skip else
                       F.when(~F.col(c).isin(*toks), F.col(c)).alias(c) for c in df.columns])


def _first_line(spark: SparkSession, path: str) -> str:
    """The header line of one file (a single short read)."""
    p, fs = _hadoop(spark, path)
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine() or ""
    finally:
        stream.close()


def _whole_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fails on a row with more fields than its header, or with an open quote (a
    value with a line break, read line by line), instead of losing text. Shorter
    rows are padded with NULL, as the source's reader does."""
    bare = F.regexp_replace(_BAD, '"[^"]*"', "")
    start = F.coalesce(F.col(f"`{columns[0]}`"), F.lit(""))
    whole = (F.when(F.col(_BAD).isNull(), True)
             .when(F.contains(bare, F.lit('"')), F.raise_error(F.concat(
                 F.lit("line break inside quotes, read with multi_line=True; row starts with: "), start)))
             .when(F.size(F.split(bare, ",")) > len(columns), F.raise_error(F.concat(
                 F.lit(f"more than {len(columns)} fields; row starts with: "), start)))
             .otherwise(True))
    return df.where(whole).drop(_BAD)


def read_raw(spark: SparkSession, source: str | list[str], pattern: str = RAW_FILE_GLOB,
             tokens: list[str] | None = None, multi_line: bool = False) -> DataFrame:
    """IO1-IO3: read every raw CSV (all columns as strings), union by name,
    null the NA tokens and keep (_file, _line) as the row order.

    Files are grouped by their header line and each group is one multi-path
    scan, so the plan has one scan per distinct header, not one per file;
    the groups are then unioned by column name. ``_file`` is the path Spark
    reports for the row's file (files sort by path, as the source sorts its
    glob) and ``_line`` (start of the split, row within the scan) increases with the
    position inside a file.

    Large files split across tasks. Values with line breaks inside quotes need
    ``multi_line=True``, which reads each file in one task; without it such a row
    fails the read. A row with more fields than its header fails it in either mode.
    """
    files = raw_files(spark, source, pattern)
    if not files:
        raise FileNotFoundError(f"No raw transaction files matching {pattern} in {source}")
    with ThreadPoolExecutor(max_workers=16) as pool:
        heads = list(pool.map(lambda path: _first_line(spark, path), files))
    groups: dict[str, list[str]] = {}
    for path, head in zip(files, heads):
        groups.setdefault(head, []).append(path)
    frames = []
    for paths in groups.values():
        reader = (spark.read.option("header", True).option("quote", '"').option("escape", '"')
                  .option("multiLine", multi_line).option("mode", "PERMISSIVE")
                  # a pruned parse would not see how many fields a row has
                  .option("columnPruning", False))
        columns = reader.csv(paths[0]).columns
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, _BAD]])
        df = reader.option("columnNameOfCorruptRecord", _BAD).schema(schema).csv(paths)
        frames.append(_whole_rows(df.withColumn("_file", F.col("_metadata.file_path"))
                                  .withColumn("_block", F.col("_metadata.file_block_start")), columns)
                      .withColumn("_line", F.struct(F.col("_block").alias("block"),
                                                    F.monotonically_increasing_id().alias("row")))
                      .drop("_block"))
    return null_tokens(union_years(frames), tokens)


def union_years(frames: list[DataFrame]) -> DataFrame:
    """IO2/U1: row-wise concatenation aligned by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def declared(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame with its columns cast to the types ``schema`` declares."""
    types = {f.name: f.dataType for f in schema.fields}
    return df.select(*[F.col(f"`{f.name}`").cast(types[f.name]).alias(f.name)
                       if types.get(f.name, f.dataType) != f.dataType else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def write_clean(df: DataFrame, parquet_path: str, csv_path: str | None = None,
                partition_by: str = "order_year") -> None:
    """IO4/IO5: the clean fact, in its declared types, as Parquet partitioned by
    year (and as CSV). Rows are rebalanced by year first: writers of an even size,
    a few files per year instead of one per task and year."""
    laid = df = declared(df, CLEAN_SCHEMA)
    if partition_by in df.columns:
        laid = laid.hint("rebalance", F.col(partition_by))
    laid = laid.sortWithinPartitions(*[c for c in (partition_by, "category", "customer_city")
                                       if c in df.columns])
    writer = laid.write.mode("overwrite")
    if partition_by in df.columns:
        writer = writer.partitionBy(partition_by)
    writer.parquet(parquet_path)
    if csv_path:
        df.write.mode("overwrite").option("header", True).csv(csv_path)


def write_report(report: DataFrame, csv_path: str) -> None:
    """IO6: the cleaning report as one small CSV (four rows)."""
    report.orderBy("step_order").select("step", "detail").coalesce(1) \
        .write.mode("overwrite").option("header", True).csv(csv_path)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a file, or a folder whose write has finished."""
    p, fs = _hadoop(spark, path)
    if not fs.exists(p):
        return False
    done, _ = _hadoop(spark, path.rstrip("/") + "/_SUCCESS")
    return fs.getFileStatus(p).isFile() or fs.exists(done)


def load_clean(spark: SparkSession, parquet_path: str, build=None) -> DataFrame:
    """IO7: read the clean Parquet, or build it with ``build()`` and write it first.
    A folder that a failed write left behind is built again."""
    if not is_complete(spark, parquet_path):
        if build is None:
            raise FileNotFoundError(parquet_path)
        write_clean(build(), parquet_path)
    return spark.read.parquet(parquet_path)


#: Columns that the declared indexes name besides the year: ids get Bloom filters, the others the curve.
CURVE_COLUMNS = ("category", "customer_city", "product_id")
BLOOM_COLUMNS = ("customer_id", "product_id", "transaction_id")


def load_warehouse(spark: SparkSession, fact: DataFrame, dims: dict[str, DataFrame],
                   location: str, database: str | None = None, buckets: int | None = None,
                   jdbc_url: str | None = None, jdbc_properties: dict | None = None,
                   curve: tuple[str, ...] = CURVE_COLUMNS, bloom: tuple[str, ...] = BLOOM_COLUMNS) -> dict[str, str]:
    """IO8/IO9: replace the fact and dimension tables, in their declared types.

    All tables are written as one new version (``sources.versions``) and become valid together: a
    load that fails leaves the tables of the last one. The catalog's tables are then pointed at
    it; :func:`register_warehouse` does that again should the load die in between.

    The fact is partitioned by year and laid out along a space-filling curve over the ``curve``
    columns, with Bloom filters for the ``bloom`` columns, so a filter on any of them skips files
    or row groups. A row hash ends the key, so a hot value spans several files, and the number of
    files grows with the shuffle partitions. With an empty ``curve`` it is laid out by ranges of
    customer_id. With ``buckets`` it is bucketed + sorted by customer_id
    instead: customer-keyed joins and aggregations then read co-located buckets
    without a shuffle, in that many tasks, so choose the number for the data. With
    ``jdbc_url`` the tables also go to a JDBC database in 10,000-row batches.
    """
    prefix = f"{database}." if database else ""
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    fact = declared(fact, TABLE_SCHEMAS["transactions"])
    dims = {name: declared(df, TABLE_SCHEMAS[name]) if name in TABLE_SCHEMAS else df for name, df in dims.items()}
    row_hash = F.xxhash64(*[F.col(c) for c in fact.columns])
    curve = tuple(c for c in curve if c in fact.columns)
    if buckets:
        # One writer per (bucket, slice): without this every input task writes a
        # file for each (year, bucket) it holds (tasks x years x buckets files).
        # Spark's bucket id is pmod(murmur3(customer_id), buckets), the same hash
        # as F.hash; a hashed slice of the row spreads a hot customer's bucket
        # over several writers (a bucket may hold several files).
        slices = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // buckets)
        bucket = F.pmod(F.hash("customer_id"), F.lit(buckets))
        laid = fact.repartition(buckets * slices, bucket, F.pmod(row_hash, F.lit(slices)))
        writer = (laid.write.mode("overwrite").partitionBy("order_year")
                  .bucketBy(buckets, "customer_id").sortBy("customer_id"))
    else:
        laid = along_curve(fact, list(curve), ["order_year"]) if curve else (
            fact.repartitionByRange("order_year", "customer_id", row_hash).sortWithinPartitions("order_year", "customer_id"))
        writer = laid.write.mode("overwrite").partitionBy("order_year") \
            .options(**bloom_options([c for c in bloom if c in fact.columns]))
    versions = Versions(spark, location)
    version = versions.stage()
    writers = {"transactions": writer} | {name: df.write.mode("overwrite") for name, df in dims.items()}
    for name, w in writers.items():
        w.option("path", versions.folder(version, name)).saveAsTable(_staged(prefix, name, version))
    versions.commit(version, list(writers))
    names = register_warehouse(spark, location, database)
    if jdbc_url:
        props = {"batchsize": "10000", **(jdbc_properties or {})}
        fact.write.jdbc(jdbc_url, "transactions", mode="overwrite", properties=props)
        for name, df in dims.items():
            df.write.jdbc(jdbc_url, name, mode="overwrite", properties=props)
    return names


def _staged(prefix: str, table: str, version: str) -> str:
    return f"{prefix}{table}__{version}"


def register_warehouse(spark: SparkSession, location: str, database: str | None = None) -> dict[str, str]:
    """Points the catalog's tables at the valid version of a warehouse folder. Tables whose
    catalog entry was lost with its session are declared again from the files."""
    prefix = f"{database}." if database else ""
    versions = Versions(spark, location)
    manifest = versions.current()
    if not manifest:
        raise FileNotFoundError(f"{location}: no complete load")
    names = {}
    for name in manifest["tables"]:
        staged, names[name] = _staged(prefix, name, manifest["version"]), f"{prefix}{name}"
        if spark.catalog.tableExists(staged):
            spark.sql(f"DROP TABLE IF EXISTS {names[name]}")        # external: the files stay
            spark.sql(f"ALTER TABLE {staged} RENAME TO {names[name]}")
        elif not spark.catalog.tableExists(names[name]):
            spark.catalog.createTable(names[name], path=versions.folder(manifest["version"], name), source="parquet")
            if name == "transactions":
                spark.catalog.recoverPartitions(names[name])
    return names


def open_warehouse(spark: SparkSession, location: str, table: str = "transactions") -> DataFrame:
    """A table of the last complete load, found by its manifest: no catalog is needed."""
    return Versions(spark, location).read(table)


def run_sql(spark: SparkSession, text: str) -> DataFrame:
    """IO10: SQL text over the registered tables/views."""
    return spark.sql(text)


def load_data(spark: SparkSession, table: str = "transactions", parquet_path: str | None = None) -> DataFrame:
    """IO11: the warehouse table when present, else the clean Parquet."""
    if spark.catalog.tableExists(table):
        return spark.table(table)
    if parquet_path and is_complete(spark, parquet_path):
        return spark.read.parquet(parquet_path)
    raise FileNotFoundError("No data found: run the clean stage first")
