"""Comparing streamed totals with a batch recompute."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventtally.config import SERVING_KEY


def reconcile(streamed: DataFrame, recomputed: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """One row per key of either side: matched, missing, extra or drift.

    `missing` is in the recompute only, `extra` in the stream only. Both sides are
    stacked and summed per key: one shuffle with sums combined before it, where a full
    join would shuffle and sort each side. A key that comes in parts is summed.
    """
    both = streamed.select(
        *SERVING_KEY, F.col("metric_value").alias("s"), F.lit(None).cast("double").alias("b")
    ).unionByName(
        recomputed.select(
            *SERVING_KEY, F.lit(None).cast("double").alias("s"), F.col("metric_value").alias("b")
        )
    )
    sums = both.groupBy(*SERVING_KEY).agg(
        F.sum("s").alias("streamed_value"), F.sum("b").alias("recomputed_value")
    )
    gap = F.col("streamed_value") - F.col("recomputed_value")
    status = (
        F.when(F.col("streamed_value").isNull(), F.lit("missing"))
        .when(F.col("recomputed_value").isNull(), F.lit("extra"))
        .when(F.abs(gap) <= tolerance, F.lit("matched"))
        .otherwise(F.lit("drift"))
    )
    return sums.withColumn("status", status).withColumn("difference", gap)


def day_digests(totals: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Per day the number of rows and two sums over their hashes, in any order.

    Two tables with one row per key have the same digest of a day if they have the same rows
    there, with values equal when rounded to the tolerance.
    """
    row = F.xxhash64(*SERVING_KEY, F.round(F.col("metric_value") / tolerance) + F.lit(0.0))
    return totals.groupBy(_day(totals).alias("day")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(row.cast("decimal(38,0)")).alias("sum"),
        F.bit_xor(row).alias("xor"),
    )


def reconcile_by_day(streamed: DataFrame, recomputed: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """`reconcile` for two tables with one row per key: only days that differ are compared.

    Days are held against one another by their digests, for which no row is shuffled. On days
    with the same digest every row is matched and goes out as it is.
    """
    ours, theirs = (day_digests(t, tolerance).withColumnRenamed("rows", "n") for t in (streamed, recomputed))
    same = [
        row["day"]
        for row in ours.join(theirs, ["day", "n", "sum", "xor"]).select("day").collect()
    ]
    equal = streamed.filter(_day(streamed).isin(same)).select(
        *SERVING_KEY,
        F.col("metric_value").alias("streamed_value"),
        F.col("metric_value").alias("recomputed_value"),
        F.lit("matched").alias("status"),
        F.lit(0.0).alias("difference"),
    )
    other = reconcile(
        *(t.filter(~F.coalesce(_day(t).isin(same), F.lit(False))) for t in (streamed, recomputed)), tolerance
    )
    return equal.unionByName(other)


def _day(totals: DataFrame) -> Column:
    return F.col("day") if "day" in totals.columns else F.to_date("window_start")
