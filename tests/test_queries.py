"""Every registered query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import as_rows
from tamiz.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).split(".")[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    frame = queries()[name](spark, SF)
    cursor = db.execute(oracle_sql()[name])
    want = as_rows([d[0] for d in cursor.description], cursor.fetchall())
    assert as_rows(frame.columns, frame.collect()) == want
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas"):
        assert unwanted not in plan


def test_entry(spark):
    frame = entry(spark)
    assert frame.count() > 0
    assert frame.columns[:2] == ["user_id", "fecha"]
