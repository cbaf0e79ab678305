"""The validating sink: good and quarantined rows add up, every rule counted; keep-first over loads."""

import random

import pytest
from pyspark.sql import functions as F

from bazaar.operators.clean import dedup_keep_first
from bazaar.sources import validate as V
from bazaar.sources.incremental import KeepFirst


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, f"T{i}", f"C{i % 7}", "A" if i % 3 else "Z", str(i) if i % 5 else f"x{i}", float(i % 11)) for i in range(400)]
    rows += [(1000 + i, "T1", "C1", "A", "1", 1.0) for i in range(150)]                      # a hot key
    rows += [(5, "T5", "C5", "A", "5", 5.0)] * 2 + [(2000, None, "C1", "A", "1", 1.0), (2001, "T2001", None, None, None, None)]
    return spark.createDataFrame(rows, "line int, id string, customer string, kind string, n string, v double").repartition(5)


@pytest.fixture(scope="module")
def rules(spark):
    parents = spark.createDataFrame([(f"C{i}",) for i in range(5)] + [(None,), ("C1",)], "c string")
    return V.Rules(checks={"v below 10": F.col("v") < 10}, vocabularies={"kind": ["A", "B"]}, types={"n": "int"},
                   unique={"id repeated": ["id"]}, foreign={"customer": (parents, "c")}, order=["line"])


def brute(rows):
    first = {}
    for r in sorted(rows, key=lambda r: r["line"]):
        first.setdefault(r["id"], r["line"])
    seen, out = set(), []
    for r in sorted(rows, key=lambda r: r["line"]):
        bad = set()
        if r["v"] is None or not r["v"] < 10:
            bad.add("v below 10")
        if r["kind"] not in (None, "A", "B"):
            bad.add("kind not in vocabulary")
        if r["n"] is not None and not r["n"].isdigit():
            bad.add("n is no int")
        if r["customer"] not in (None, *(f"C{i}" for i in range(5))):
            bad.add("customer has no parent")
        if r["id"] is None or r["line"] != first[r["id"]] or r["id"] in seen:
            bad.add("id repeated")
        seen.add(r["id"])
        out.append((r["line"], sorted(bad)))
    return sorted(out)


def test_judged_equals_brute_force(table, rules):
    got = sorted((r["line"], r["_broken"]) for r in V.judged(table, rules).collect())
    assert [(a, sorted(b)) for a, b in got] == brute(table.collect())


def test_good_and_quarantined_add_up(spark, table, rules, scratch):
    counts = {r["rule"]: r["rows"] for r in V.write_validated(table, scratch, rules).collect()}
    want = brute(table.collect())
    assert counts["good"] == sum(not b for _, b in want) and counts["quarantined"] == sum(bool(b) for _, b in want)
    for name in {n for _, b in want for n in b}:
        assert counts[name] == sum(name in b for _, b in want)
    good, bad = V.good_rows(spark, scratch), V.quarantined(spark, scratch).drop("_broken")
    assert good.columns == table.columns and good.unionAll(bad).exceptAll(table).count() == 0 and good.count() + bad.count() == table.count()
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_good" in plan                 # good rows never touch the quarantine
    V.write_validated(table.where("line < 10"), scratch, V.Rules())
    assert V.good_rows(spark, scratch).count() == table.where("line < 10").count() and V.quarantined(spark, scratch).count() == 0


def test_two_loads_equal_one(spark, scratch):
    rng = random.Random(8)
    rows = [(f"f{i % 4}", i, f"T{rng.randint(0, 60)}" if rng.random() > 0.05 else None, rng.random()) for i in range(500)]
    cols, order = "file string, line int, id string, v double", ["file", "line"]
    whole = {tuple(r) for r in dedup_keep_first(spark.createDataFrame(rows, cols), "id", order).collect()}
    for arrival in (["f0", "f1", "f2", "f3"], ["f3", "f1", "f0", "f2"], ["f2", "f2", "f0", "f1", "f3", "f0"]):
        table = KeepFirst(spark, f"{scratch}/{''.join(arrival)}", "id", order)
        assert table.table() is None
        for f in arrival:
            table.load(spark.createDataFrame([r for r in rows if r[0] == f], cols).repartition(3))
        got = [tuple(r) for r in table.table().collect()]
        assert len(got) == len(set(got)) and set(got) == whole
    table.load(spark.createDataFrame([], cols))
    assert {tuple(r) for r in table.table().collect()} == whole


def test_failed_load_changes_nothing(spark, scratch):
    table = KeepFirst(spark, scratch, "id", ["line"])
    table.load(spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "line int, id string"))
    bad = spark.createDataFrame([(0, "a")], "line int, id string").withColumn("line", F.when(F.col("id") == "a", F.raise_error(F.lit("no")).cast("int")))
    with pytest.raises(Exception, match="no"):
        table.load(bad)
    assert sorted(tuple(r) for r in table.table().collect()) == [(1, "a"), (3, "b")]
