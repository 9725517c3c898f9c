"""Window totals with the late rows kept: partial sums and a ledger of event time.

Built-in watermarks drop late rows. This job keeps no state; each batch knows the
largest event time of the batches before it from a ledger, sets apart the rows whose
window closed by then, and writes the sums of the others as partials. Totals are the
sums of the partials. Every table has one folder per batch and a batch that runs again
replaces its own, so late rows and totals together always hold each row once.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventtally.config import Settings
from eventtally.operators.deltas import event_deltas
from eventtally.operators.events import parse_events
from eventtally.operators.lateness import is_late, millis
from eventtally.operators.totals import window_start, window_totals
from eventtally.session import is_finished
from eventtally.sinks.batch_log import (
    append_batch,
    claim,
    claimed_by_stream,
    read_log,
    sum_partials,
    write_gathered,
)
from eventtally.sinks.dead_letters import append_dead_letters
from eventtally.sinks.published import last_finished, publish_captured
from eventtally.streaming.served import ServedQuery

LATE_SCHEMA = (
    "metric_name STRING, delta_value DOUBLE, event_time TIMESTAMP, ingested_at TIMESTAMP, "
    "batch_id BIGINT"
)
LEDGER_SCHEMA = "max_event_ms BIGINT"
RECORD_SCHEMA = "raw STRING, ingest_time TIMESTAMP, source STRING"


def seen_before_batch(spark: SparkSession, ledger_path: str, batch_id: int) -> int | None:
    """Largest event time of all earlier batches, in milliseconds.

    Ledger rows carry the running maximum, so the row of the batch before is enough.
    """
    if batch_id == 0:
        return None
    before = f"{ledger_path}/batch_id={batch_id - 1}"
    if not is_finished(spark, before):
        raise RuntimeError(f"no ledger row for batch {batch_id - 1}")
    return spark.read.schema(LEDGER_SCHEMA).parquet(before).first()[0]


def write_ledger(
    spark: SparkSession, ledger_path: str, batch_id: int, max_event_ms: int | None
) -> None:
    spark.range(1).select(F.lit(max_event_ms).cast("long").alias("max_event_ms")).write.mode(
        "overwrite"
    ).parquet(f"{ledger_path}/batch_id={batch_id}")


def capture_batch(
    deltas: DataFrame, batch_id: int, path: str, settings: Settings = Settings()
) -> None:
    """Split one batch of deltas and write its late rows, partial sums and ledger row.

    `deltas` carry the time they were landed as `ingested_at`. The caller keeps them
    at hand: they are read three times. The ledger row comes last, so a batch without
    one has not happened.
    """
    spark = deltas.sparkSession
    seen = seen_before_batch(spark, f"{path}/ledger", batch_id)
    end = window_start("event_time", settings.window_size) + F.expr(
        f"INTERVAL {settings.window_size}"
    )
    late = is_late(millis(end), F.lit(seen).cast("long"), settings)
    late_rows = deltas.filter(late).select(
        "metric_name", F.col("delta").alias("delta_value"), "event_time", "ingested_at"
    )
    write_gathered(late_rows, f"{path}/late/batch_id={batch_id}", settings.files_per_batch)
    append_batch(
        window_totals(deltas.filter(~late), settings.window_size),
        f"{path}/partials",
        batch_id,
        settings.files_per_batch,
    )
    top = deltas.agg(F.max(millis(F.col("event_time")))).first()[0]
    tops = [t for t in (seen, top) if t is not None]
    write_ledger(spark, f"{path}/ledger", batch_id, max(tops) if tops else None)


def capture_raw_batch(
    raw: DataFrame, batch_id: int, path: str, settings: Settings = Settings()
) -> None:
    """The same from raw records; unreadable ones go to the dead letters.

    Records are parsed once. What is kept of a batch while it is written is the parsed
    fields, and the text of unreadable records only. With `record_batches` the records are
    first written as they came, under the number of their batch, and read from there.
    """
    if settings.record_batches:
        folder = f"{path}/records/batch_id={batch_id}"
        write_gathered(raw.select("raw", "ingest_time", "source"), folder, settings.files_per_batch)
        raw = raw.sparkSession.read.schema(RECORD_SCHEMA).parquet(folder)
    parsed = parse_events(raw).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        append_dead_letters(
            parsed, f"{path}/dead_letters", batch_id, settings.files_per_batch
        )
        deltas = event_deltas(parsed, keep=["ingest_time"]).withColumnRenamed(
            "ingest_time", "ingested_at"
        )
        capture_batch(deltas, batch_id, path, settings)
    finally:
        parsed.unpersist()


def start_capture(
    raw: DataFrame,
    path: str,
    checkpoint: str,
    settings: Settings = Settings(),
    available_now: bool = False,
    batch_function: Callable[[DataFrame, int, str, Settings], None] = capture_raw_batch,
    serving_path: str | None = None,
    publish_every: int = 10,
    publish_seconds: float = 60,
    rollups: Sequence[str] = (),
) -> StreamingQuery:
    """Run the capture over a stream of raw records with `source` and `ingest_time`.

    With a serving table, the totals that have changed are put there after every so many
    batches, every so many seconds, with or without input, and when the query has ended; so are
    their sums over the larger windows `rollups`.
    """
    lock = threading.Lock()

    def run(batch: DataFrame, batch_id: int) -> None:
        with lock:
            claimed_by_stream(batch, path)
            batch_function(batch, batch_id, path, settings)
            if serving_path is not None and (batch_id + 1) % publish_every == 0:
                publish_captured(raw.sparkSession, path, serving_path, rollups)

    writer = raw.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
    if available_now:
        writer = writer.trigger(availableNow=True)
    query = writer.start()
    if serving_path is None:
        return query

    def publish() -> None:
        claim(raw.sparkSession, path, str(query.id))
        publish_captured(raw.sparkSession, path, serving_path, rollups)

    return ServedQuery(query, publish, publish_seconds, lock)


def captured_totals(spark: SparkSession, path: str) -> DataFrame:
    """Totals of all on-time rows so far."""
    return sum_partials(read_log(spark, f"{path}/partials"))


def captured_late_rows(spark: SparkSession, path: str) -> DataFrame:
    """All rows that came too late, with the batch they came in."""
    return spark.read.schema(LATE_SCHEMA).parquet(f"{path}/late")


def captured_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The largest event time up to each finished batch: batch_id, max_event_ms."""
    return spark.read.schema(f"{LEDGER_SCHEMA}, batch_id BIGINT").parquet(f"{path}/ledger")


def recorded_batches(spark: SparkSession, path: str) -> DataFrame:
    """The records of all finished batches as they came, with their batch."""
    done = last_finished(spark, f"{path}/ledger")
    records = spark.read.schema(f"{RECORD_SCHEMA}, batch_id BIGINT").parquet(f"{path}/records")
    return records.filter(F.col("batch_id") <= F.lit(-1 if done is None else done))
