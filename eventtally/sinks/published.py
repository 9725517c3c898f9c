"""From the log of a stream to the serving table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from eventtally.config import SERVING_COLUMNS
from eventtally.operators.totals import rollup_levels
from eventtally.session import is_finished, numbered, remove_folder, set_mark
from eventtally.sinks.batch_log import Fold, added, fold_log, newest, read_touched
from eventtally.sinks.serving import finish_upsert, upsert_serving

NOTHING_PUBLISHED = -1


def published_upto(spark: SparkSession, path: str) -> int:
    """The last batch whose totals the serving table holds."""
    return max(numbered(spark, f"{path}/published", "upto"), default=NOTHING_PUBLISHED)


def last_finished(spark: SparkSession, path: str) -> int | None:
    """The last batch below a folder that was written to its end."""
    for number in reversed(numbered(spark, path, "batch_id")):
        if is_finished(spark, f"{path}/batch_id={number}"):
            return number
    return None


def publish(
    spark: SparkSession,
    path: str,
    log_path: str,
    fold: Fold,
    done: int | None,
    serving_path: str,
    rollups: Sequence[str] = (),
) -> None:
    """Upsert the totals of all windows that batches up to `done` have changed since the last time,
    and of the larger windows of the sizes `rollups` on the days of these. A size must divide a day.

    Only the days of these windows are read and written, in the log and in the serving
    table. A call that broke off can be made again: the log is folded under a mark, and a swap
    of days that has begun is finished from the days kept aside for it.
    """
    work = f"{path}/publish"
    if is_finished(spark, f"{work}/days"):
        finish_upsert(spark, serving_path, work)
    before = published_upto(spark, path)
    if done is not None and done > before:
        fold_log(spark, log_path, fold, done)
        touched = read_touched(spark, log_path, before)
        updates = touched.filter(F.col("batch_id") > before).select(*SERVING_COLUMNS)
        if rollups:
            updates = updates.unionByName(rollup_levels(touched, rollups))
        upsert_serving(spark, serving_path, updates, work)
        set_mark(spark, f"{path}/published/upto={done}")
        for number in numbered(spark, f"{path}/published", "upto"):
            if number < done:
                remove_folder(spark, f"{path}/published/upto={number}")
    remove_folder(spark, work)


def publish_captured(
    spark: SparkSession, path: str, serving_path: str, rollups: Sequence[str] = ()
) -> None:
    """`publish` for a capture; finished batches are those with a row in the ledger."""
    done = last_finished(spark, f"{path}/ledger")
    publish(spark, path, f"{path}/partials", added, done, serving_path, rollups)


def publish_totals(spark: SparkSession, log_path: str, serving_path: str) -> None:
    """`publish` for a log of replaced totals."""
    done = last_finished(spark, f"{log_path}/batches")
    publish(spark, log_path, log_path, newest, done, serving_path)
