"""Records that could not be read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventtally.config import ACTIVITIES_DLQ_TOPIC, TRANSACTIONS_DLQ_TOPIC
from eventtally.sinks.batch_log import write_gathered
from eventtally.sinks.topic_files import FORMAT, TopicFiles
from eventtally.sources.topics import TRANSACTION

LETTER_SCHEMA = "raw STRING, source STRING, reason STRING, ingested_at TIMESTAMP"
MALFORMED = "malformed"
UNKNOWN_TYPE = "unknown_type"


def dead_letters(parsed: DataFrame) -> DataFrame:
    """The unreadable records of a parsed frame, with the time they were landed."""
    return parsed.filter(F.col("reason").isNotNull()).select(
        F.col("dead_raw").alias("raw"),
        "source",
        "reason",
        F.col("ingest_time").alias("ingested_at"),
    )


def append_dead_letters(
    parsed: DataFrame, path: str, batch_id: int, files: int | None = None
) -> None:
    """Append the unreadable records of a batch; a repeated batch replaces itself."""
    write_gathered(dead_letters(parsed), f"{path}/batch_id={batch_id}", files)


def dead_letter_records(letters: DataFrame) -> DataFrame:
    """Dead letters as records for the dead-letter topics: key, value and topic.

    The record goes as it came, below the topic of its source; one of an unknown source goes
    with the activities. The key is the reason.
    """
    topic = F.when(F.col("source") == TRANSACTION, TRANSACTIONS_DLQ_TOPIC).otherwise(ACTIVITIES_DLQ_TOPIC)
    return letters.select(F.col("reason").alias("key"), F.col("raw").alias("value"), topic.alias("topic"))


def start_dead_letter_topics(
    spark: SparkSession, letters_path: str, topics_path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Send the letters that a capture sets apart on to the dead-letter topics, as files."""
    spark.dataSource.register(TopicFiles)
    letters = spark.readStream.schema(LETTER_SCHEMA).parquet(letters_path)
    writer = (
        dead_letter_records(letters)
        .select("topic", "key", "value")
        .writeStream.format(FORMAT)
        .option("path", topics_path)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
