"""The queries of this package that SQL can express, against that SQL."""

import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(ROOT, "tools"))

from __spark_entry__ import SMOKE_DIR, oracle_sql, queries  # noqa: E402
from check_queries import TABLES, compare  # noqa: E402

from eventtally.llm.queries import load  # noqa: E402

NAMES, SQL = load()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMOKE_DIR}/{table}.parquet'")
    return connection


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in NAMES) == list(range(1, 14))
    assert {*NAMES, "pipeline"} <= set(queries()) and set(SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    problems, count, _, _ = compare(spark, con, name, SMOKE_DIR)
    assert not problems and count > 0
