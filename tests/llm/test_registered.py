"""The registered queries: names, and equality with SQL where there is one."""

import duckdb
import pytest

import __spark_entry__ as E
from bazaar.llm import queries as Q

SF = "/root/testdata/sf0.001"


def test_names():
    names = set(E.queries())
    assert {n.split("_")[0] for n in Q.queries()} == {f"op{i}" for i in range(1, 14)}
    assert set(Q.queries()) | {"pipeline"} <= names


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    df = Q.queries()[name](spark, SF)
    cols = sorted(df.columns)
    want = con.execute(f"select {', '.join(cols)} from ({Q.oracle_sql()[name]})").fetchall()
    assert sorted(tuple(r) for r in df.select(*cols).collect()) == sorted(want)
