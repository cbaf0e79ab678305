"""Raw CSV reading (by-name union, NA tokens), sinks, warehouse, stages."""

import os

import pytest
from pyspark.sql import functions as F

from bazaar.operators import inject as G
from bazaar.plans import pipeline as P
from bazaar.sources import files as IO
from bazaar.sources.tables import sales
from sf_paths import SF_SMALL


def _write_year_csv(df, path):
    pdf = df.toPandas()
    pdf.to_csv(path, index=False)


def test_read_raw_aligns_by_name_and_nulls_tokens(spark, scratch):
    a = spark.createDataFrame([("T1", "2020-01-05", "NA"), ("T2", "05/11/2020", "100")],
                              "transaction_id string, order_date string, final_amount_inr string")
    b = spark.createDataFrame([("200", "T3", "2021-02-03")],
                              "final_amount_inr string, transaction_id string, order_date string")
    _write_year_csv(a, os.path.join(scratch, "orders_2020.csv"))
    _write_year_csv(b, os.path.join(scratch, "orders_2021.csv"))
    raw = IO.read_raw(spark, scratch)
    got = {r.transaction_id: (r.order_date, r.final_amount_inr, r._file) for r in raw.collect()}
    assert got["T3"][:2] == ("2021-02-03", "200")     # columns aligned by name, not position
    assert got["T1"][:2] == ("2020-01-05", None)      # 'NA' is missing
    # the file key orders rows by file as the sorted glob does
    assert got["T3"][2].endswith("orders_2021.csv") and got["T1"][2].endswith("orders_2020.csv")
    assert got["T1"][2] < got["T3"][2]


def test_read_raw_one_scan_per_header(spark, scratch):
    cols = "transaction_id string, order_date string, final_amount_inr string"
    for year in range(2015, 2021):
        rows = [(f"T{year}-{i}", f"{year}-01-0{i + 1}", str(i)) for i in range(3)]
        _write_year_csv(spark.createDataFrame(rows, cols), os.path.join(scratch, f"orders_{year}.csv"))
    raw = IO.read_raw(spark, scratch)
    plan = raw._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1
    rows = raw.orderBy("_file", "_line").collect()
    assert [r.transaction_id for r in rows] == [f"T{y}-{i}" for y in range(2015, 2021) for i in range(3)]


def test_read_raw_missing_input(spark, scratch):
    with pytest.raises(FileNotFoundError):
        IO.read_raw(spark, os.path.join(scratch, "nothing-here"))


def test_stages_end_to_end(spark, scratch):
    """Write the dirty view as yearly CSV files, run clean -> eda -> db."""
    raw_dir = os.path.join(scratch, "raw")
    os.makedirs(raw_dir)
    fact = sales(spark, SF_SMALL).drop("order_month", "order_quarter")
    dirty = G.dirty(fact)
    for y in (1995, 1996, 1997, 1998, 1999, 2000, 2001):
        part = dirty.where(F.col("order_year") == str(y))
        _write_year_csv(part, os.path.join(raw_dir, f"orders_{y}.csv"))
    out = os.path.join(scratch, "out")
    res = P.run(spark, raw_dir, out, stages=["clean", "eda", "db"], window=("1995-01-01", "2001-12-31"),
                database="bazaar_test")
    clean = spark.read.parquet(res["clean"])
    assert clean.count() > 0
    assert {"order_year", "category", "customer_city"} <= set(clean.columns)
    report = spark.read.option("header", True).csv(os.path.join(out, "cleaning_report.csv"))
    assert [r.step for r in report.collect()] == ["duplicates", "dropped_invalid", "rows", "null_pct"]
    eda = res["eda"]
    assert len(eda) == 25 and not any(isinstance(v, Exception) for v in eda.values())
    assert spark.table("bazaar_test.transactions").count() == clean.count()
    assert spark.table("bazaar_test.customers").count() == clean.select("customer_id").distinct().count()
    loaded = IO.load_data(spark, "bazaar_test.transactions")
    assert loaded.count() == clean.count()
    with pytest.raises(ValueError):
        P.run(spark, raw_dir, out, stages=["bogus"])


def test_run_all_is_fail_soft(spark):
    df = spark.createDataFrame([(2020, 1.0)], "order_year int, final_amount_inr double")
    out = P.run_all(df, questions={"ok": lambda d: d.groupBy("order_year").count(),
                                   "bad": lambda d: d.select("no_such_column")})
    assert not isinstance(out["ok"], Exception) and isinstance(out["bad"], Exception)


def test_run_all_parallel_keeps_order_and_fail_soft(spark):
    df = sales(spark, SF_SMALL)
    from bazaar.operators.reports import EDA_QUESTIONS
    qs = dict(list(EDA_QUESTIONS.items())[:6])
    qs["bad"] = lambda d: d.select("no_such_column")
    done = {}
    seq = P.run_all(df, questions=qs)
    par = P.run_all(df, sink=lambda n, f: done.setdefault(n, f.count()), questions=qs, parallel=3)
    assert list(par) == list(qs) and isinstance(par["bad"], Exception)
    def rows(frame):  # double sums differ in the last digit with merge order
        return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in frame.collect())
    for name in qs:
        if name != "bad":
            assert rows(par[name]) == rows(seq[name])
    assert set(done) == set(qs) - {"bad"}


def test_load_clean_builds_once(spark, scratch):
    path = os.path.join(scratch, "clean.parquet")
    calls = []

    def build():
        calls.append(1)
        return spark.createDataFrame([(2020, "X", "C", 1.0)],
                                     "order_year int, category string, customer_city string, v double")
    a = IO.load_clean(spark, path, build)
    b = IO.load_clean(spark, path, build)
    assert a.count() == b.count() == 1 and len(calls) == 1
    assert os.path.isdir(os.path.join(path, "order_year=2020"))


def test_dashboard_filters_prune_and_push_down(spark, scratch):
    from bazaar.operators import reports as R
    path = os.path.join(scratch, "fact")
    IO.write_clean(sales(spark, SF_SMALL), path)
    fact = spark.read.parquet(path)
    df = R.category_revenue(R.global_filters(fact, (1996, 1999), ["LARGE"], ["ASIA"]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_year" in plan and "(order_year#" in plan
    assert "In(category, [LARGE])" in plan or "EqualTo(category,LARGE)" in plan
    assert "ReadSchema: struct<category:string,final_amount_inr:double,customer_tier:string>" in plan


def test_warehouse_writes_one_file_per_bucket_and_year(spark, scratch):
    import glob
    fact = sales(spark, SF_SMALL)
    prev = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        IO.load_warehouse(spark, fact, {}, os.path.join(scratch, "wh"), database="bazaar_bucket_test",
                          buckets=4)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", prev)
    years = glob.glob(os.path.join(scratch, "wh", "versions", "*", "transactions", "order_year=*"))
    assert years
    for d in years:
        files = [f for f in os.listdir(d) if f.endswith(".parquet")]
        assert 0 < len(files) <= 4, (d, files)
    t = spark.table("bazaar_bucket_test.transactions")
    assert t.count() == fact.count()
    # every file holds the customers of exactly one bucket
    per_file = t.select(F.input_file_name().alias("f"), F.pmod(F.hash("customer_id"), F.lit(4)).alias("b")) \
        .groupBy("f").agg(F.count_distinct("b").alias("nb"))
    assert per_file.agg(F.max("nb")).first()[0] == 1


def test_read_raw_single_line_mode_reads_the_same_rows(spark, scratch):
    a = spark.createDataFrame([("T1", "2020-01-05", "1"), ("T2", "N/A", "2")],
                              "transaction_id string, order_date string, final_amount_inr string")
    b = spark.createDataFrame([("3", "T3", "2021-02-03")],
                              "final_amount_inr string, transaction_id string, order_date string")
    _write_year_csv(a, os.path.join(scratch, "orders_2020.csv"))
    _write_year_csv(b, os.path.join(scratch, "orders_2021.csv"))
    cols = ["transaction_id", "order_date", "final_amount_inr", "_file"]
    multi = sorted(tuple(r) for r in IO.read_raw(spark, scratch).select(*cols).collect())
    single = sorted(tuple(r) for r in IO.read_raw(spark, scratch, multi_line=False).select(*cols).collect())
    assert multi == single and len(multi) == 3
    assert ("T2", None, "2") == multi[1][:3]          # 'N/A' is missing in both modes


def test_read_raw_fails_on_lost_fields_and_pads_short_rows(spark, scratch):
    def write(name, text):
        os.makedirs(os.path.join(scratch, name))
        with open(os.path.join(scratch, name, "orders_2020.csv"), "w") as fh:
            fh.write("transaction_id,order_date,final_amount_inr\n" + text)
        return os.path.join(scratch, name)
    short = IO.read_raw(spark, write("short", 'T1,2020-01-05\nT2,"a,b ""c""",3\n'))
    assert short.count() == 2
    assert sorted(tuple(r)[:3] for r in short.select("transaction_id", "order_date", "final_amount_inr").collect()) == [
        ("T1", "2020-01-05", None), ("T2", 'a,b "c"', "3")]
    for multi_line in (False, True):
        with pytest.raises(Exception, match="more than 3 fields"):
            IO.read_raw(spark, write(f"long{multi_line}", "T1,2020-01-05,1,lost\n"), multi_line=multi_line).collect()
    broken = write("broken", 'T1,"two\nlines",1\n')
    with pytest.raises(Exception, match="multi_line=True"):
        IO.read_raw(spark, broken).count()
    assert IO.read_raw(spark, broken, multi_line=True).first().order_date == "two\nlines"


def test_read_raw_splits_a_file_and_keeps_its_order(spark, scratch):
    n = 5000
    with open(os.path.join(scratch, "orders_2020.csv"), "w") as fh:
        fh.write("transaction_id,order_date\n" + "".join(f"T{i:06d},2020-01-05\n" for i in range(n)))
    prev = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        raw = IO.read_raw(spark, "file:" + scratch)
        assert raw.select(F.spark_partition_id().alias("p")).distinct().count() > 1
        got = [r.transaction_id for r in raw.orderBy("_file", "_line").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", prev)
    assert got == [f"T{i:06d}" for i in range(n)]


def test_half_written_clean_folder_is_built_again(spark, scratch):
    path = os.path.join(scratch, "clean.parquet")
    os.makedirs(os.path.join(path, "_temporary"))
    with pytest.raises(FileNotFoundError):
        IO.load_clean(spark, path)
    built = IO.load_clean(spark, path, lambda: spark.createDataFrame([(2020, 1.0)], "order_year int, v double"))
    assert built.count() == 1


def test_stages_compute_the_clean_fact_and_leave_no_intermediates(spark, scratch):
    from bazaar.session import ensure_checkpoint_dir
    raw_dir = os.path.join(scratch, "raw")
    os.makedirs(raw_dir)
    fact = sales(spark, SF_SMALL).drop("order_month", "order_quarter").where("order_year = 1996")
    _write_year_csv(G.dirty(fact), os.path.join(raw_dir, "orders_2996.csv"))
    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    res = P.run(spark, raw_dir, os.path.join(scratch, "out"), stages=["eda"], window=("1995-01-01", "2001-12-31"))
    assert len(res["eda"]) == 25 and not any(isinstance(v, Exception) for v in res["eda"].values())
    assert not {f for f in set(os.listdir(base)) - before if f.startswith("bazaar-")}


def test_warehouse_spreads_a_hot_customer_and_declares_types(spark, scratch):
    from bazaar.schema import CLEAN_SCHEMA
    fact = sales(spark, SF_SMALL).where("order_year = 1996").withColumn("customer_id", F.lit("hot")) \
        .withColumn("order_year", F.col("order_year").cast("long"))
    prev = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        IO.load_warehouse(spark, fact, {}, os.path.join(scratch, "wh"), database="bazaar_range_test")
    finally:
        for c, v in prev.items():
            spark.conf.set(c, v)
    t = spark.table("bazaar_range_test.transactions")
    assert t.count() == fact.count()
    assert t.select(F.input_file_name()).distinct().count() > 1
    types = {f.name: f.dataType for f in CLEAN_SCHEMA.fields}
    assert all(types[f.name] == f.dataType for f in t.schema.fields)
