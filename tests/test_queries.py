"""Every registered query against its SQL, on the smallest tables."""

import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

from __spark_entry__ import SMOKE_DIR, entry, oracle_sql, queries  # noqa: E402
from check_queries import TABLES, compare  # noqa: E402
from eventtally.queries.registry import load  # noqa: E402

# The queries of the optional parts are tested with them.
OWN = load()[0]


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMOKE_DIR}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(OWN) <= set(queries()) and set(OWN) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(OWN))
def test_query(spark, con, name):
    problems, count, _, _ = compare(spark, con, name, SMOKE_DIR)
    assert not problems and count > 0
