"""Working out again, from what a capture has recorded, which rows were late."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventtally.config import Settings
from eventtally.operators.deltas import event_deltas
from eventtally.operators.events import parse_events
from eventtally.operators.lateness import late_split
from eventtally.streaming.late_capture import captured_ledger, recorded_batches


def replayed_deltas(spark: SparkSession, path: str, settings: Settings = Settings()) -> DataFrame:
    """All recorded deltas with `ingest_time`, `batch_id`, `window_end` and `late`.

    The batches and their ledger are those of the capture, the bound and the lateness those
    of `settings`: the same give the rows that the capture set apart, others show what they
    would have changed. Events are judged first and fan out into metrics after.
    """
    parsed = parse_events(recorded_batches(spark, path), keep=["batch_id"])
    judged = late_split(
        parsed.filter("reason IS NULL"),
        captured_ledger(spark, path),
        settings,
        spread_by=["event_time", "ingest_time", "action", "amount"],
    )
    return event_deltas(judged, keep=["ingest_time", "batch_id", "window_end", "late"])
