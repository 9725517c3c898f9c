"""Which rows of a stream were too late, and the totals without them.

A row is late when, by the time its batch came, the largest event time of all batches before was
at least B + L past the end of the row's window. A ledger holds that running maximum, a row
per batch, so a row is judged by one join with the ledger row of the batch before its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventtally.config import Settings
from eventtally.functions.skew import lookup_join
from eventtally.operators.totals import start_of, window_start


def millis(at: Column) -> Column:
    return F.unix_millis(at.cast("timestamp"))


def is_late(window_end_ms: Column, seen_ms: Column, settings: Settings) -> Column:
    """Exactly B + L past the window end is late, one millisecond less is not."""
    delay = settings.watermark_delay_seconds * 1000
    return F.coalesce(window_end_ms + delay <= seen_ms, F.lit(False))


def late_split(
    log: DataFrame, ledger: DataFrame, settings: Settings, spread_by: list[str]
) -> DataFrame:
    """Every row of the log with `window_end` and `late`; none is lost or repeated.

    `log` has `event_time` and `batch_id`, `ledger` has for each batch the largest event time
    up to its end, `max_event_ms`. A row without a batch, or of a batch without one before it
    in the ledger, is on time; so is one without an event time, which has no window.
    """
    size = settings.window_size
    kind = dict(log.dtypes)["event_time"]
    end = start_of(F.col("event_time"), size, kind) + F.expr(f"INTERVAL {size}")
    before = ledger.select(
        (F.col("batch_id") + 1).cast(dict(log.dtypes)["batch_id"]).alias("batch_id"),
        F.col("max_event_ms").alias("_seen_ms"),
    )
    joined = lookup_join(log.withColumn("window_end", end), before, ["batch_id"], spread_by, "left")
    late = is_late(millis(F.col("window_end")), F.col("_seen_ms"), settings)
    return joined.select(*log.columns, "window_end", late.alias("late"))


def split_totals(judged_deltas: DataFrame, size: str = "1 minute") -> DataFrame:
    """Totals per metric and window, of on-time deltas and of late ones apart."""
    sums = (
        judged_deltas.withColumn("window_start", window_start("event_time", size))
        .groupBy("metric_name", "window_start")
        .agg(
            F.sum(F.when(~F.col("late"), F.col("delta"))).alias("metric_value"),
            F.count_if("late").alias("late_rows"),
            F.sum(F.when(F.col("late"), F.col("delta")).otherwise(0.0)).alias("late_value"),
        )
    )
    end = F.col("window_start") + F.expr(f"INTERVAL {size}")
    return sums.withColumn("window_end", end)


def on_time_totals(judged_deltas: DataFrame, size: str = "1 minute") -> DataFrame:
    """What a stream with these settings would have served: totals without the late rows."""
    return (
        split_totals(judged_deltas, size)
        .filter(F.col("metric_value").isNotNull())
        .select("metric_name", "metric_value", "window_start", "window_end")
    )
