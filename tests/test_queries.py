"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
CORE = [k for k in __spark_entry__.queries() if not k.startswith("op") and k != "pipeline"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def cell(v):
    if v is None or v is pd.NA or v is pd.NaT or v != v:
        return "null"
    if isinstance(v, float):
        return str(int(v)) if v == int(v) else repr(round(v, 9))
    return str(v)


def rows(frame):
    columns = sorted(frame.columns)
    return columns, sorted(tuple(map(cell, r)) for r in frame[columns].itertuples(index=False))


@pytest.mark.parametrize("name", CORE)
def test_query(spark, duck, name):
    got = __spark_entry__.queries()[name](spark, SF).toPandas()
    sql = __spark_entry__.oracle_sql().get(name)
    if sql is not None:
        assert rows(got) == rows(duck.execute(sql).fetchdf())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_oracles_have_queries():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
