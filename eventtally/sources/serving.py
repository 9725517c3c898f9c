"""The serving table of window totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventtally.config import SERVING_COLUMNS, SERVING_TABLE, Settings


def read_serving(spark: SparkSession, path: str) -> DataFrame:
    """Totals by day folder; filters on day and on the columns reach the files."""
    return spark.read.parquet(path).select(*SERVING_COLUMNS, "day")


def read_committed(spark: SparkSession, path: str) -> DataFrame:
    """The same with `committed_at`, the time at which the file of a row was written."""
    written = F.col("_metadata.file_modification_time").alias("committed_at")
    return spark.read.parquet(path).select(*SERVING_COLUMNS, "day", written)


def first_windows_path(path: str) -> str:
    """Where the index of first windows lies: next to the table, not among its days."""
    return f"{path.rstrip('/')}-first-windows"


def read_first_windows(spark: SparkSession, path: str) -> DataFrame:
    """The index of a serving table: the first window of each metric, day and length."""
    return spark.read.parquet(first_windows_path(path)).select(*SERVING_COLUMNS, "day")


def read_serving_jdbc(
    spark: SparkSession, settings: Settings, table: str = SERVING_TABLE
) -> DataFrame:
    """The same table in a database; filters and column choice run there."""
    if settings.jdbc_url is None:
        raise ValueError("settings.jdbc_url is not set")
    reader = spark.read.format("jdbc").option("url", settings.jdbc_url)
    if settings.jdbc_user is not None:
        reader = reader.option("user", settings.jdbc_user)
    if settings.jdbc_password is not None:
        reader = reader.option("password", settings.jdbc_password)
    return reader.option("dbtable", table).load().select(*SERVING_COLUMNS)
