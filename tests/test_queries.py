"""Every registered query, against its SQL check where it has one."""

import math
import os

import pytest

import __spark_entry__ as contract

duckdb = pytest.importorskip("duckdb")

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables not present")


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    return value


def test_every_check_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, database, name):
    df = contract.queries()[name](spark, DATA)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    rows = df.collect()
    assert rows
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return
    want = database.sql(sql)
    columns, want = list(want.columns), want.fetchall()
    order = sorted(columns)
    assert sorted(df.columns) == order
    at = [columns.index(c) for c in order]
    got = sorted(repr(tuple(plain(r[c]) for c in order)) for r in rows)
    assert got == sorted(repr(tuple(plain(r[i]) for i in at)) for r in want)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
