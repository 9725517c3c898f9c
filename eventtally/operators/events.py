"""From raw records to readable events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventtally.functions import parsing
from eventtally.sinks.dead_letters import MALFORMED, UNKNOWN_TYPE
from eventtally.sources.topics import ACTIVITY, TRANSACTION


def parse_events(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Read every record once and keep one row per record.

    Takes `raw`, `ingest_time` and `source`. A record that is no JSON keeps its text in
    `dead_raw` with a `reason`, and has no event time; so has one whose source is not
    known. Fields that are absent or unusable take their defaults.
    """
    keep = keep or []
    value = F.col("value")
    known = F.coalesce(F.col("source").isin(TRANSACTION, ACTIVITY), F.lit(False))
    reason = F.when(value.isNull(), F.lit(MALFORMED)).when(~known, F.lit(UNKNOWN_TYPE))
    json = value if "value" in raw.columns else parsing.parsed_json(F.col("raw"))
    parsed = raw.select("raw", "ingest_time", "source", *keep, json.alias("value"))
    # Fields are taken out in a step of their own, so that none is looked up twice.
    fields = parsed.select(
        "raw",
        "ingest_time",
        "source",
        *keep,
        reason.alias("reason"),
        parsing.scalar_text(value, "timestamp").alias("event_text"),
        F.when(F.col("source") == TRANSACTION, parsing.double_field(value, "amount")).alias(
            "amount"
        ),
        F.when(F.col("source") == ACTIVITY, parsing.field(value, "action")).alias("action"),
        F.when(F.col("source") == ACTIVITY, parsing.field(value, "activity")).alias("activity"),
    )
    readable = F.col("reason").isNull()
    action = parsing.action_or_unknown(
        parsing.field_text(F.col("action")), parsing.field_text(F.col("activity"))
    )
    return fields.select(
        "source",
        F.when(readable, parsing.event_time(F.col("event_text"), F.col("ingest_time"))).alias(
            "event_time"
        ),
        F.when(readable, F.col("amount")).alias("amount"),
        F.when(readable & (F.col("source") == ACTIVITY), action).alias("action"),
        F.when(~readable, F.col("raw")).alias("dead_raw"),
        "reason",
        "ingest_time",
        *keep,
    )


def route_events(raw: DataFrame) -> DataFrame:
    """Tell the kind of each record of a mixed feed by its `type` field.

    The parsed record goes on as `value`, so `parse_events` does not read it again.

    The source of a record without a known type is NULL or the text it carried;
    `parse_events` marks it as a dead letter.
    """
    parsed = raw.withColumn("value", parsing.parsed_json(F.col("raw")))
    return (
        parsed.withColumn("_type", parsing.field(F.col("value"), "type"))
        .withColumn("source", parsing.field_text(F.col("_type")))
        .drop("_type")
    )


def canonical_transactions(events: DataFrame) -> DataFrame:
    """Typed transactions: ids as text, exact amounts, epoch milliseconds as instants."""
    return events.select(
        F.col("id").cast("string").alias("transactionId"),
        F.col("user_id").cast("string").alias("userId"),
        F.col("amount").cast("decimal(18,2)").alias("amount"),
        "currency",
        "status",
        F.timestamp_millis("timestamp_ms").alias("timestamp"),
    )


def canonical_activities(events: DataFrame) -> DataFrame:
    """Typed activities; metadata stays text."""
    return events.select(
        F.col("id").cast("string").alias("activityId"),
        F.col("user_id").cast("string").alias("userId"),
        F.col("activity").alias("activityType"),
        "metadata",
        F.timestamp_millis("timestamp_ms").alias("timestamp"),
    )
