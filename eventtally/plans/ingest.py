"""Taking in events: keep them as they came and publish them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from eventtally.config import Settings
from eventtally.sinks.raw import append_raw
from eventtally.sinks.topics import published_records, write_kafka, write_topic_files
from eventtally.sources.topics import TRANSACTION


def ingest_batch(
    events: DataFrame,
    batch_id: int,
    source: str,
    raw_path: str,
    settings: Settings,
    topic_path: str | None = None,
) -> None:
    """Store a batch, then publish it if that is switched on.

    A batch that fails half way is run again as a whole: the store and a topic folder
    replace what they hold of it, Kafka may see its records twice.
    """
    events = events.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        append_raw(events, source, raw_path, batch_id)
        if not settings.publish_enabled:
            return
        records = published_records(events, source)
        if topic_path is not None:
            write_topic_files(records, topic_path, batch_id)
        else:
            topic = (
                settings.transactions_topic
                if source == TRANSACTION
                else settings.activities_topic
            )
            write_kafka(records, topic, settings)
    finally:
        events.unpersist()


def ingest_function(
    source: str, raw_path: str, settings: Settings, topic_path: str | None = None
) -> Callable[[DataFrame, int], None]:
    """The same for `foreachBatch`."""

    def run(events: DataFrame, batch_id: int) -> None:
        ingest_batch(events, batch_id, source, raw_path, settings, topic_path)

    return run
