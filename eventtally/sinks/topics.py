"""Publishing events as keyed JSON records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventtally.config import Settings
from eventtally.sources.topics import ACTIVITY, TRANSACTION

# Published fields by kind of event.
PUBLISHED = {
    TRANSACTION: ["id", "description", "amount", "currency", "status", "timestamp"],
    ACTIVITY: ["id", "activity", "description", "timestamp"],
}


def published_records(events: DataFrame, source: str) -> DataFrame:
    """Key: the id as text. Value: every field as JSON, also those that are null."""
    body = F.to_json(F.struct(*PUBLISHED[source]), {"ignoreNullFields": "false"})
    return events.select(
        F.col("id").cast("string").alias("key"), body.alias("value"), "ingest_time"
    )


def write_topic_files(records: DataFrame, path: str, batch_id: int) -> None:
    """Publish a batch to a folder; a repeated batch replaces itself."""
    records.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def write_kafka(records: DataFrame, topic: str, settings: Settings) -> None:
    """Publish a batch to Kafka; needs the Kafka connector package."""
    (
        records.select("key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", settings.kafka_bootstrap)
        .option("topic", topic)
        .save()
    )
