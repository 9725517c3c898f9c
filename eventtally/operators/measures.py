"""Throughput, freshness and ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventtally.config import SERVING_KEY
from eventtally.operators.lookup import window_of_event
from eventtally.operators.totals import window_start


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds with their fraction."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return micros / F.lit(1e6)


def throughput(events: DataFrame, size: str = "1 hour") -> DataFrame:
    """Events per window and per second of the window."""
    end = F.col("window_start") + F.expr(f"INTERVAL {size}")
    counts = (
        events.withColumn("window_start", window_start("event_time", size))
        .groupBy("window_start")
        .agg(F.count(F.lit(1)).alias("n_events"))
    )
    return counts.withColumn(
        "events_per_second", F.col("n_events") / seconds_between(F.col("window_start"), end)
    )


def overall_throughput(events: DataFrame) -> DataFrame:
    """All events over the time from the first to the last."""
    sums = events.agg(
        F.count(F.lit(1)).alias("n_events"),
        F.min("event_time").alias("first_at"),
        F.max("event_time").alias("last_at"),
    )
    span = seconds_between(F.col("first_at"), F.col("last_at"))
    return sums.withColumn("seconds", span).withColumn(
        "events_per_second", F.try_divide(F.col("n_events"), F.col("seconds"))
    )


def freshness(
    events: DataFrame,
    committed: DataFrame,
    size: str = "1 minute",
    visible_within_seconds: int = 120,
    spread_by: list[str] | None = None,
) -> DataFrame:
    """Seconds from each event to the first total of its window that could be read.

    `events` name a metric and an event time, `committed` holds totals with the time
    each became readable. An event whose window has no total yet, or one that came too
    late, is not visible.
    """
    first = committed.groupBy(*SERVING_KEY).agg(F.min("committed_at").alias("committed_at"))
    joined = window_of_event(events, first, size, spread_by, how="left")
    lag = seconds_between(F.col("event_time"), F.col("committed_at"))
    visible = F.coalesce(F.col("lag_seconds") <= visible_within_seconds, F.lit(False))
    return (
        joined.withColumn("lag_seconds", lag)
        .withColumn("visible", visible)
        .select(*events.columns, "window_start", "lag_seconds", "visible")
    )


def served_freshness(
    deltas: DataFrame,
    served: DataFrame,
    size: str = "1 minute",
    visible_within_seconds: int = 120,
) -> DataFrame:
    """Seconds from the landing of a window's last row to the commit of the file that serves it.

    `deltas` carry `ingest_time`, the time their record was landed; `served` is a serving table
    with `committed_at`, the time its files were written. A day that is written again later
    has later files, so the lag is an upper bound.
    """
    landed = (
        deltas.withColumn("window_start", window_start("event_time", size))
        .groupBy("metric_name", "window_start")
        .agg(F.max("ingest_time").alias("landed_at"))
        .withColumn("window_end", F.col("window_start") + F.expr(f"INTERVAL {size}"))
    )
    joined = landed.join(served.select(*SERVING_KEY, "committed_at"), SERVING_KEY, "left")
    lag = seconds_between(F.col("landed_at"), F.col("committed_at"))
    visible = F.coalesce(F.col("lag_seconds").between(0, visible_within_seconds), F.lit(False))
    return (
        joined.withColumn("lag_seconds", lag)
        .withColumn("visible", visible)
        .select(*SERVING_KEY, "landed_at", "committed_at", "lag_seconds", "visible")
    )


def ratio(events: DataFrame, flag: Column, size: str = "1 hour") -> DataFrame:
    """Share of the events of each window for which a flag is set."""
    return (
        events.withColumn("window_start", window_start("event_time", size))
        .groupBy("window_start")
        .agg(
            F.count(F.lit(1)).alias("n_events"),
            F.count_if(flag).alias("n_flagged"),
            F.avg(F.coalesce(flag, F.lit(False)).cast("double")).alias("ratio"),
        )
    )
