"""Window totals of deltas, and totals of totals."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventtally.config import (
    ACTIVITY_COUNT,
    SERVING_COLUMNS,
    SERVING_KEY,
    TRANSACTION_AMOUNT,
    TRANSACTION_COUNT,
)
from eventtally.functions.parsing import UNKNOWN_ACTION
from eventtally.operators.deltas import action_metric


def window_start(at: str, size: str) -> Column:
    """Start of the epoch-aligned tumbling window an instant falls into."""
    return F.window(at, size)["start"]


UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400, "week": 604_800}


def size_micros(size: str) -> int:
    """Length of a window, as "15 minutes"."""
    number, unit = size.split()
    return int(number) * UNITS[unit.rstrip("s")] * 1_000_000


def start_of(at: Column, size: str, kind: str) -> Column:
    """The same worked out by hand: rows without a time stay, with no window."""
    micros = F.unix_micros(at.cast("timestamp"))
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(size_micros(size)))).cast(kind)


def _with_end(totals: DataFrame, size: str) -> DataFrame:
    end = F.col("window_start") + F.expr(f"INTERVAL {size}")
    return totals.withColumn("window_end", end).select(*SERVING_COLUMNS)


def window_totals(deltas: DataFrame, size: str = "1 minute") -> DataFrame:
    """Sum of the deltas per metric and window.

    Sums are combined before the shuffle, so the few metric names and a busy window do
    not load single tasks.
    """
    totals = (
        deltas.withColumn("window_start", window_start("event_time", size))
        .groupBy("window_start", "metric_name")
        .agg(F.sum("delta").alias("metric_value"))
    )
    return _with_end(totals, size)


def transaction_totals(transactions: DataFrame, size: str = "1 minute") -> DataFrame:
    """Both transaction metrics, summed before they fan out: one row per event, not two."""
    sums = (
        transactions.withColumn("window_start", window_start("event_time", size))
        .groupBy("window_start")
        .agg(
            F.count(F.lit(1)).cast("double").alias("n"),
            F.sum(F.coalesce(F.col("amount"), F.lit(0.0))).alias("amount"),
        )
    )
    pairs = F.array(
        F.struct(F.lit(TRANSACTION_COUNT).alias("metric_name"), F.col("n").alias("metric_value")),
        F.struct(
            F.lit(TRANSACTION_AMOUNT).alias("metric_name"), F.col("amount").alias("metric_value")
        ),
    )
    return _with_end(sums.select("window_start", F.inline(pairs)), size)


def activity_totals(activities: DataFrame, size: str = "1 minute") -> DataFrame:
    """Activity metrics: counts per action first, names and the overall count after.

    The action text is normalised once per window and distinct text instead of once per
    event.
    """
    known = activities.withColumn("action", F.coalesce("action", F.lit(UNKNOWN_ACTION)))
    counts = (
        known.withColumn("window_start", window_start("event_time", size))
        .groupBy("window_start", "action")
        .agg(F.count(F.lit(1)).cast("double").alias("n"))
    )
    pairs = F.array(
        F.struct(F.lit(ACTIVITY_COUNT).alias("metric_name"), F.col("n").alias("n")),
        F.struct(action_metric(F.col("action")).alias("metric_name"), F.col("n").alias("n")),
    )
    sums = (
        counts.select("window_start", F.inline(pairs))
        .groupBy("window_start", "metric_name")
        .agg(F.sum("n").alias("metric_value"))
    )
    return _with_end(sums, size)


def event_totals(
    transactions: DataFrame, activities: DataFrame, size: str = "1 minute"
) -> DataFrame:
    """All four kinds of metric; equal to `window_totals` over the union of the deltas.

    The two halves share no metric name, so their union needs no further sum.
    """
    return transaction_totals(transactions, size).unionByName(activity_totals(activities, size))


def merged_totals(*partials: DataFrame) -> DataFrame:
    """Partial totals added up per key."""
    rows = reduce(DataFrame.unionByName, (p.select(*SERVING_COLUMNS) for p in partials))
    return (
        rows.groupBy(*SERVING_KEY)
        .agg(F.sum("metric_value").alias("metric_value"))
        .select(*SERVING_COLUMNS)
    )


def rollup_totals(totals: DataFrame, size: str) -> DataFrame:
    """Totals of larger windows from totals of smaller ones, without the events."""
    sums = (
        totals.withColumn("window_start", window_start("window_start", size))
        .groupBy("window_start", "metric_name")
        .agg(F.sum("metric_value").alias("metric_value"))
    )
    return _with_end(sums, size)


def rollup_levels(totals: DataFrame, sizes: Sequence[str]) -> DataFrame:
    """Totals of windows of several larger sizes at once.

    Grouping sets give every size from one pass over the totals and one shuffle, with the sums
    of all sizes combined before it.
    """
    starts = {size: f"_start{k}" for k, size in enumerate(sizes)}
    at, kind = F.col("window_start"), dict(totals.dtypes)["window_start"]
    rows = totals.select(
        "metric_name",
        "metric_value",
        *(start_of(at, size, kind).alias(name) for size, name in starts.items()),
    )
    sums = rows.groupingSets(
        [["metric_name", name] for name in starts.values()], "metric_name", *starts.values()
    ).agg(F.sum("metric_value").alias("metric_value"))
    # Of the starts only that of a row's own set is filled.
    start = F.coalesce(*starts.values())
    end = F.coalesce(*(F.col(name) + F.expr(f"INTERVAL {size}") for size, name in starts.items()))
    return sums.select(
        "metric_name", "metric_value", start.alias("window_start"), end.alias("window_end")
    )


def closed_totals(totals: DataFrame, max_event_time: Column, bound_seconds: int) -> DataFrame:
    """Totals of windows whose end the watermark has passed."""
    bound = F.expr(f"INTERVAL {int(bound_seconds)} SECONDS")
    return totals.filter(F.col("window_end") + bound <= max_event_time)
