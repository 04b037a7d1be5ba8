"""Every query with SQL against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from cladespark.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def comparable(value):
    if value is None or value != value:
        return "null"
    return f"{value:.6g}" if isinstance(value, float) else str(value)


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_same_rows(spark, duck, name):
    got = registry.QUERIES[name](spark, SF)
    rows = sorted(tuple(comparable(r[c]) for c in sorted(got.columns)) for r in got.collect())
    if name not in registry.ORACLE_SQL:
        assert got.columns
        return
    want = duck.sql(registry.ORACLE_SQL[name])
    assert sorted(want.columns) == sorted(got.columns)
    order = [want.columns.index(c) for c in sorted(want.columns)]
    assert rows == sorted(tuple(comparable(r[i]) for i in order) for r in want.fetchall())
