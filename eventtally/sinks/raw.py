"""The store of events as they arrived."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventtally.sources.topics import ACTIVITY, TRANSACTION

# Stored columns by kind of event; the event's id is kept as event_id.
STORED = {
    TRANSACTION: ["event_id", "description", "amount", "currency", "status", "timestamp"],
    ACTIVITY: ["event_id", "activity", "description", "timestamp"],
}


def raw_records(events: DataFrame, source: str) -> DataFrame:
    """Events in the layout of the raw store; timestamps stay the text they were."""
    return events.withColumnRenamed("id", "event_id").select(
        *STORED[source], F.to_date("ingest_time").alias("ingest_date")
    )


def append_raw(events: DataFrame, source: str, path: str, batch_id: int) -> None:
    """Append a batch; the same batch written again replaces itself, nothing else."""
    (
        raw_records(events, source)
        .withColumn("batch_id", F.lit(batch_id).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ingest_date", "batch_id")
        .parquet(path)
    )
