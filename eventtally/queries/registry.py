"""All registered queries and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventtally.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    """Register a query under its function's name, with the SQL for the same result."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(configure(spark), sf_dir)

        QUERIES[build.__name__] = run
        ORACLES[build.__name__] = sql
        return build

    return register


def load() -> tuple[dict[str, Query], dict[str, str]]:
    """Both tables, after all query modules have been read."""
    from eventtally.queries import events, insights, serving, streams, totals  # noqa: F401

    return QUERIES, ORACLES
