"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from verify import TABLES, normal

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got[1]
        return
    result = con.execute(sql)
    assert got == normal([d[0] for d in result.description], result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
