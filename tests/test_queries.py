"""Every registered query against its oracle on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import TABLES, compare

FOLDER = os.environ.get("TARN_TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, db, name):
    df = entry.queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        verdict = compare(df, db, sql)
        assert verdict.startswith("ok"), verdict


def test_entry(spark):
    assert entry.entry(spark).columns[:2] == ["window_start", "window_end"]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
