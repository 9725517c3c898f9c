"""Window totals as a streaming aggregation."""

from __future__ import annotations

import threading
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventtally.config import Settings
from eventtally.sinks.batch_log import append_batch, claim, claimed_by_stream
from eventtally.sinks.published import publish_totals
from eventtally.streaming.served import ServedQuery

# What a query takes over from the session when it starts. With one stateful operator per query
# late rows are dropped in the batch that follows the one which advanced the watermark, not one batch later.
# State lies in RocksDB, outside the heap, and a batch writes the changes of state only.
QUERY_SETTINGS = {
    "spark.sql.streaming.statefulOperator.allowMultiple": "false",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def streaming_totals(deltas: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Totals per metric and window, kept until the watermark is B + L past the window.

    State is one number per metric and open window.
    """
    return (
        deltas.withWatermark("event_time", f"{settings.watermark_delay_seconds} seconds")
        .groupBy(F.window("event_time", settings.window_size).alias("window"), "metric_name")
        .agg(F.sum("delta").alias("metric_value"))
        .select(
            "metric_name",
            "metric_value",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
        )
    )


@contextmanager
def query_settings(spark: SparkSession):
    """The settings while a query starts; the session gets its own back."""
    before = {name: spark.conf.get(name, None) for name in QUERY_SETTINGS}
    for name, value in QUERY_SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def start_totals(
    deltas: DataFrame,
    log_path: str,
    checkpoint: str,
    settings: Settings = Settings(),
    available_now: bool = False,
    closed_only: bool = False,
    serving_path: str | None = None,
    publish_every: int = 10,
    publish_seconds: float = 60,
) -> StreamingQuery:
    """Keep a log of changed totals; `batch_log.latest_totals` folds it to the table.

    Each batch appends only the totals it changed, under its own number, so a batch that
    runs again replaces itself and no batch rewrites the days it touches. With `closed_only`
    a total is written once, when its window has closed. With a serving table, the totals that
    have changed are put there, as `start_capture` does.
    """
    spark = deltas.sparkSession
    lock = threading.Lock()

    def write(totals: DataFrame, batch_id: int) -> None:
        with lock:
            claimed_by_stream(totals, log_path)
            append_batch(totals, log_path, batch_id, settings.files_per_batch)
            if serving_path is not None and (batch_id + 1) % publish_every == 0:
                publish_totals(spark, log_path, serving_path)

    with query_settings(spark):
        writer = (
            streaming_totals(deltas, settings)
            .writeStream.outputMode("append" if closed_only else "update")
            .option("checkpointLocation", checkpoint)
            .foreachBatch(write)
        )
        if available_now:
            writer = writer.trigger(availableNow=True)
        query = writer.start()
    if serving_path is None:
        return query

    def publish() -> None:
        claim(spark, log_path, str(query.id))
        publish_totals(spark, log_path, serving_path)

    return ServedQuery(query, publish, publish_seconds, lock)


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The totals that a query holds as state after its last batch, from its checkpoint.

    Closed windows have left the state, so these are the windows that can still change.
    """
    state = spark.read.format("statestore").load(checkpoint)
    return state.select(
        F.col("key.metric_name").alias("metric_name"),
        F.col("value.sum").alias("metric_value"),
        F.col("key.window.start").alias("window_start"),
        F.col("key.window.end").alias("window_end"),
    )
