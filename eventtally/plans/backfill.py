"""Recomputing the totals of a time range from stored events."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventtally.config import (
    ACTIVITY_COUNT,
    ACTIVITY_COUNT_PREFIX,
    TRANSACTION_AMOUNT,
    TRANSACTION_COUNT,
    Settings,
)
from eventtally.operators.lookup import bound_literal, request_bound
from eventtally.operators.totals import event_totals, window_start
from eventtally.operators.users import between
from eventtally.session import shared_folder
from eventtally.sinks.serving import replace_windows


def recomputed_totals(
    transactions: DataFrame,
    activities: DataFrame,
    start: str,
    end: str,
    settings: Settings = Settings(),
) -> DataFrame:
    """Totals of the windows that begin in [start, end).

    The events are cut by event time in the scan. The bounds must lie on window
    boundaries, or the first and last window would be recomputed from some of their
    events only.
    """
    spark = transactions.sparkSession
    for bound in (start, end):
        _require_boundary(spark, bound, settings.window_size)
    return event_totals(
        between(transactions, start, end), between(activities, start, end), settings.window_size
    )


def _require_boundary(spark: SparkSession, bound: str, size: str) -> None:
    at = request_bound(bound)
    row = spark.range(1).select(F.lit(at).cast("timestamp_ntz").alias("at"))
    if row.select(window_start("at", size)).first()[0] != at:
        raise ValueError(f"{bound} is not a boundary of {size} windows")


def backfill(
    spark: SparkSession,
    transactions: DataFrame,
    activities: DataFrame,
    start: str,
    end: str,
    serving_path: str,
    settings: Settings = Settings(),
) -> None:
    """Replace the totals of the windows that begin in [start, end) from stored events.

    A window of the range that has no events any more loses its totals. Totals of other
    metrics or window sizes, as rollups and imports are, stay. What is written comes from
    the events alone; after a failure the same call can simply be made again.
    """
    spark = transactions.sparkSession
    totals = recomputed_totals(transactions, activities, start, end, settings)
    low, high = request_bound(start), request_bound(end)
    kind = dict(totals.dtypes)["window_start"]
    begins, name = F.col("window_start"), F.col("metric_name")
    replaced = (
        (begins >= bound_literal(low, kind))
        & (begins < bound_literal(high, kind))
        & (F.col("window_end") == begins + F.expr(f"INTERVAL {settings.window_size}"))
        & (name.isin(TRANSACTION_COUNT, TRANSACTION_AMOUNT, ACTIVITY_COUNT) | name.startswith(ACTIVITY_COUNT_PREFIX))
    )
    days = low.date(), (high - timedelta(microseconds=1)).date()
    replace_windows(spark, serving_path, totals, replaced, days, shared_folder(spark, "backfill"))
