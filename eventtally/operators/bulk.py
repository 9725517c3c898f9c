"""Bulk activity requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventtally.functions.parsing import instant


def valid_activity(activity: Column) -> Column:
    """An activity is taken if it has an id, a user, an action and a readable instant."""
    return F.coalesce(
        activity["id"].isNotNull()
        & (F.length(F.trim(activity["userId"])) > 0)
        & (F.length(F.trim(activity["action"])) > 0)
        & instant(activity["timestamp"]).isNotNull(),
        F.lit(False),
    )


def bulk_accounting(requests: DataFrame) -> DataFrame:
    """Taken and refused activities of each request, counted inside its row: no shuffle."""
    taken = F.size(F.filter("activities", valid_activity))
    return requests.withColumn("success_count", taken).withColumn(
        "failure_count", F.size("activities") - taken
    ).drop("activities")


def bulk_activities(requests: DataFrame) -> DataFrame:
    """The taken activities of all requests, one per row."""
    taken = F.filter("activities", valid_activity)
    return requests.select(F.inline(taken)).select(
        "id",
        F.col("userId").alias("user_id"),
        "action",
        instant(F.col("timestamp")).alias("event_time"),
    )
