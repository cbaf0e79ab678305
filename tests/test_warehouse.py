"""The warehouse: curve layout and Bloom filters skip row groups, loads replace all tables or none."""

import glob
import os

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from bazaar.operators import dims as D
from bazaar.sources import files as IO
from bazaar.sources import layout as L
from bazaar.sources.tables import sales
from bazaar.sources.versions import Versions
from sf_paths import SF_CHECK, SF_SMALL


def test_curve_places_are_equi_depth_and_ordered(spark):
    rng = np.random.default_rng(3)
    values = [f"v{int(x):05d}" for x in rng.lognormal(6, 1.5, 4000)] + ["v00000"] * 2000
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "c string").repartition(5)
    rows = sorted((r["c"], r["place"]) for r in L.curve_places(df, "c", 4).collect())
    assert [c for c, _ in rows] == sorted(set(values))
    places = [p for _, p in rows]
    assert places == sorted(places) and places[0] == 0 and places[-1] == 15
    below, ranks = 0, {}
    for v in sorted(set(values)):
        ranks[v] = below * 16 // len(values)
        below += values.count(v)
    assert dict(rows) == ranks


def test_z_value_interleaves(spark):
    got = spark.createDataFrame([(0b10, 0b01), (0b11, 0b00), (63, 63)], "a int, b int") \
        .select(L.z_value([F.col("a"), F.col("b")]).alias("z")).collect()
    assert [r["z"] for r in got] == [0b1001, 0b1010, (1 << 12) - 1]


def _rows_read(df):
    """Rows that the scan of ``df`` handed on, from the plan's metrics."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    todo, total = [plan], 0
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        if name == "FileSourceScanExec":
            total += node.metrics().apply("numOutputRows").value()
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return total


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("wh"))
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    keep = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "256")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf.set("parquet.block.size", "65536")
    try:
        fact = sales(spark, SF_CHECK)
        IO.load_warehouse(spark, fact, {}, path, database="bazaar_curve_test")
    finally:
        conf.unset("parquet.block.size")
        for c, v in keep.items():
            spark.conf.set(c, v)
    return path, fact


@pytest.mark.parametrize("column, share", [("category", 0.5), ("customer_city", 0.5), ("product_id", 0.6)])
def test_a_filter_reads_few_rows(spark, warehouse, column, share):
    path, fact = warehouse
    table = IO.open_warehouse(spark, path)
    value = fact.groupBy(column).count().orderBy("count").first()[0]
    found = table.where(F.col(column) == value)
    assert found.count() == fact.where(F.col(column) == value).count() > 0
    read = _rows_read(found)
    print(column, read)
    assert read < share * table.count()        # some 36 tasks a year: 5 bits for three columns


def test_year_is_pruned_and_ids_have_bloom_filters(spark, warehouse):
    path, fact = warehouse
    table = spark.table("bazaar_curve_test.transactions")
    one_year = table.where("order_year = 1996 and category = 'PROMO'")
    assert "PartitionFilters: [isnotnull(order_year" in one_year._jdf.queryExecution().executedPlan().toString()
    assert _rows_read(one_year) < fact.where("order_year = 1996").count()
    files = glob.glob(os.path.join(path, "versions", "*", "transactions", "order_year=*", "*.parquet"))
    assert len(files) > 7 and pq.read_metadata(files[0]).num_row_groups >= 1
    one = fact.select("transaction_id").orderBy("transaction_id").first()[0]
    found = table.where(F.col("transaction_id") == one)
    assert found.count() == 1 and _rows_read(found) < 0.3 * fact.count()


def test_failed_load_leaves_the_old_tables(spark, scratch):
    fact = sales(spark, SF_SMALL)
    args = (os.path.join(scratch, "wh"), "bazaar_version_test")
    IO.load_warehouse(spark, fact.where("order_year = 1996"), {"customers": D.customer_dim(fact)}, *args)
    old = fact.where("order_year = 1996").count()
    broken = D.customer_dim(fact).withColumn("total_spend", F.raise_error(F.lit("half-way")).cast("double"))
    with pytest.raises(Exception, match="half-way"):
        IO.load_warehouse(spark, fact, {"customers": broken}, *args)
    assert spark.table("bazaar_version_test.transactions").count() == old
    assert IO.open_warehouse(spark, args[0]).count() == old and IO.open_warehouse(spark, args[0], "customers").count() > 0
    IO.load_warehouse(spark, fact, {"customers": D.customer_dim(fact)}, *args)
    assert spark.table("bazaar_version_test.transactions").count() == IO.open_warehouse(spark, args[0]).count() == fact.count()


def test_commit_without_catalog_is_registered_later(spark, scratch, monkeypatch):
    fact = sales(spark, SF_SMALL)
    args = (os.path.join(scratch, "wh"), "bazaar_register_test")
    IO.load_warehouse(spark, fact.where("order_year = 1996"), {}, *args)
    with monkeypatch.context() as m:
        m.setattr(IO, "register_warehouse", lambda *a: {})        # dies between the commit and the catalog
        IO.load_warehouse(spark, fact, {}, *args)
    assert IO.open_warehouse(spark, args[0]).count() == fact.count()
    IO.register_warehouse(spark, *args)
    assert spark.table("bazaar_register_test.transactions").count() == fact.count()
    spark.sql("DROP TABLE bazaar_register_test.transactions")       # a new session without a metastore
    IO.register_warehouse(spark, *args)
    assert spark.table("bazaar_register_test.transactions").where("order_year = 1997").count() == fact.where("order_year = 1997").count()


def test_manifests(spark, scratch):
    v = Versions(spark, scratch)
    assert v.current() is None
    with pytest.raises(FileNotFoundError):
        v.read("t")
    made = []
    for n in range(4):
        version = v.stage()
        spark.range(n + 1).write.parquet(v.folder(version, "t"))
        made.append(v.commit(version, ["t"])["version"])
        assert v.read("t").count() == n + 1
    with open(os.path.join(scratch, "manifests", "00000005.json"), "w") as f:
        f.write('{"version": "torn')                                # its writer died
    assert v.current()["version"] == made[-1] and v.commit(v.stage(), [])["number"] == 6
    reader = v.read("t", made[2])
    assert v.retire(keep=3) == made[:2] and reader.count() == 3
    assert sorted(os.listdir(os.path.join(scratch, "versions"))) == sorted(made[2:])


def test_large_place_tables_are_cut_to_their_bounds(spark):
    """Beyond the broadcast bound a row's place comes from the smallest value of every place."""
    df = spark.createDataFrame([(f"v{i * i % 997:04d}", i % 3) for i in range(3000)] + [(None, 1)], "c string, n int")
    places = L.curve_places(df, "c", 4)
    want = {r["c"]: r["place"] for r in places.collect()} | {None: None}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1KB")
    try:
        got = L._placed(df, "c", places, "p")
        plan = got._jdf.queryExecution().executedPlan().toString()
        rows = got.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" not in plan and "BroadcastNestedLoopJoin" in plan
    assert len(rows) == 3001 and {r["c"]: r["p"] for r in rows} == want
