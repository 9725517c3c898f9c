"""Per-user reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventtally.operators.lookup import bound_literal, request_bound
from eventtally.operators.totals import window_start


def between(events: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Events of [start, end); an open bound keeps everything on its side."""
    kind = dict(events.dtypes)["event_time"]
    if start is not None:
        events = events.filter(F.col("event_time") >= bound_literal(request_bound(start), kind))
    if end is not None:
        events = events.filter(F.col("event_time") < bound_literal(request_bound(end), kind))
    return events


def transaction_summary(transactions: DataFrame) -> DataFrame:
    """Number, sum, mean and range of the amounts of each user, with first and last time."""
    return transactions.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_transactions"),
        F.sum("amount").alias("total_amount"),
        F.avg("amount").alias("avg_amount"),
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
        F.min("event_time").alias("first_at"),
        F.max("event_time").alias("last_at"),
    )


def activity_trend(activities: DataFrame, size: str = "1 day") -> DataFrame:
    """Count per user, action and window, with the change from the window before it.

    Counts are made first, so the ordered step sees one row per window however many
    events a user has. "Before" is the last earlier window with any such activity.
    """
    counts = (
        activities.withColumn("bucket", window_start("event_time", size))
        .groupBy("user_id", "action", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    order = Window.partitionBy("user_id", "action").orderBy("bucket")
    return counts.withColumn("change", F.col("n") - F.lag("n").over(order))
