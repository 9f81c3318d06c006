"""Every registered query against its SQL oracle, on the smallest data."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from workload.check import table
from workload.fixtures import BASE

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in BASE:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(entry.queries()) - set(entry.LLM_QUERIES) == set(ORACLE) - set(entry.LLM_ORACLE)


# Queries of the optional subpackage are tested in its own folder.
@pytest.mark.parametrize("name", [n for n in entry.queries() if n not in entry.LLM_QUERIES])
def test_query(spark, db, name):
    df = entry.queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # No pairwise joins, apart from none at all: every join has equal keys.
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    got = table(df.columns, [tuple(r) for r in df.collect()])
    result = db.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == table(columns, result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
