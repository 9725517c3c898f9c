"""What several operators of this package share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventtally.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

# Words are runs of anything but these six characters (space, tab to carriage return).
WORD_SEPARATORS = "[\\x20\\x09-\\x0D]+"


# Rows of a batch between Spark and Python: texts can be long, and two copies are held.
BATCH_ROWS = 1000


def ship_package(spark: SparkSession) -> None:
    """Send this library to the Python workers, once per application."""
    context = spark.sparkContext
    if getattr(context, "_eventtally_sent", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="eventtally-"), "eventtally.zip")
    with zipfile.ZipFile(archive, "w") as file:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    file.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    context._eventtally_sent = True


def prepare(spark: SparkSession) -> None:
    """What every operator with Python work needs: this library, and small batches of texts."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with the SQL for the same result if any."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return build(configure(spark), sf_dir)

        QUERIES[build.__name__] = run
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else, so that no character changes its length."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """The words of a text with A-Z lowered; none for a null text."""
    parts = F.split(F.coalesce(ascii_lower(text), F.lit("")), WORD_SEPARATORS)
    return F.filter(parts, lambda word: word != "")


def fold_of(identifier: Column, folds: int) -> Column:
    """crc32 of the identifier as text, modulo the number of folds; null for a null one."""
    return F.crc32(identifier.cast("string").cast("binary")) % folds


def joined(parts: Column) -> Column:
    return F.array_join(parts, "", "")
