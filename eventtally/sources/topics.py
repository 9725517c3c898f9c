"""Event topics: Kafka, or folders that hold one text record per row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventtally.config import Settings

TRANSACTION = "transaction"
ACTIVITY = "activity"


def kafka_topic(spark: SparkSession, settings: Settings, topic: str) -> DataFrame:
    """Stream the values of a Kafka topic; needs the Kafka connector package.

    The record time Kafka gives stands in for the time an event was landed. It does
    not change when a batch runs again.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", settings.kafka_bootstrap)
        .option("subscribe", topic)
        .option("startingOffsets", settings.starting_offsets)
        .option("kafka.group.id", settings.consumer_group(topic))
    )
    if settings.max_offsets_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", settings.max_offsets_per_trigger)
    return reader.load().select(
        F.col("value").cast("string").alias("raw"), F.col("timestamp").alias("ingest_time")
    )


def file_topic(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    """Stream the records of a folder written by `sinks.topics.write_topic_files`."""
    reader = spark.readStream.schema("key STRING, value STRING, ingest_time TIMESTAMP")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path).select(F.col("value").alias("raw"), "ingest_time")


def stored_topic(spark: SparkSession, path: str) -> DataFrame:
    """The same records as a table, with their keys."""
    return spark.read.schema("key STRING, value STRING, ingest_time TIMESTAMP").parquet(path)


def transactions_stream(spark: SparkSession, settings: Settings) -> DataFrame:
    return kafka_topic(spark, settings, settings.transactions_topic)


def activities_stream(spark: SparkSession, settings: Settings) -> DataFrame:
    return kafka_topic(spark, settings, settings.activities_topic)


def as_source(raw: DataFrame, source: str) -> DataFrame:
    """Say which kind of event a topic carries."""
    return raw.withColumn("source", F.lit(source))


def both_topics(transactions: DataFrame, activities: DataFrame) -> DataFrame:
    """One frame of raw records of both kinds."""
    return as_source(transactions, TRANSACTION).unionByName(
        as_source(activities, ACTIVITY)
    )
