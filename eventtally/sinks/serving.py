"""Writing the serving table: day folders, sorted for range reads.

Next to the table lies an index of first windows: a row per metric, day and length of window, with
the first window of that length. It is written anew for the days that a write touches.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eventtally.config import SERVING_COLUMNS, SERVING_KEY, SERVING_TABLE, Settings
from eventtally.session import names_in, remove_folder
from eventtally.sources.serving import first_windows_path


def write_serving(totals: DataFrame, path: str) -> None:
    """Replace the day folders that occur in `totals`; other days stay as they are.

    `totals` must hold all rows of each of its days. Files follow the size of a day:
    small days share a task, a very large one is split.
    """
    days = Observation()
    (
        totals.select(*SERVING_COLUMNS, F.to_date("window_start").alias("day"))
        .hint("rebalance", "day")
        .sortWithinPartitions("day", "metric_name", "window_start")
        # Observed last: a step below a shuffle without rows is dropped together with it.
        .observe(days, F.collect_set(F.col("day")).alias("days"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .parquet(path)
    )
    _index(totals.sparkSession, path, days.get["days"])


def first_windows(totals: DataFrame) -> DataFrame:
    """The first window of each length, per metric and day."""
    day = F.col("day") if "day" in totals.columns else F.to_date("window_start")
    length = F.unix_micros(F.col("window_end").cast("timestamp")) - F.unix_micros(
        F.col("window_start").cast("timestamp")
    )
    return (
        totals.groupBy("metric_name", day.alias("day"), length.alias("length"))
        .agg(F.min(F.struct("window_start", "window_end", "metric_value")).alias("first"))
        .select("metric_name", "length", "first.*", "day")
    )


def _index(spark: SparkSession, path: str, days: list[date]) -> None:
    """Write the index of some days anew; a day without rows leaves it."""
    if not days:
        return
    index = first_windows_path(path)
    found = Observation()
    (
        first_windows(spark.read.parquet(path).filter(F.col("day").isin(days)))
        .hint("rebalance", "day")
        .observe(found, F.collect_set(F.col("day")).alias("days"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .parquet(index)
    )
    for day in {*days} - {*(found.get["days"] or [])}:
        remove_folder(spark, f"{index}/day={day}")


def upserted(current: DataFrame, updates: DataFrame) -> DataFrame:
    """Rows after an upsert: a key in both keeps the value of the update.

    One shuffle on the key. Updates that repeat a key count as one; the caller
    gives them an order by folding them first (`batch_log.latest_totals`).
    """
    versions = current.select(*SERVING_COLUMNS, F.lit(0).alias("version")).unionByName(
        updates.select(*SERVING_COLUMNS, F.lit(1).alias("version"))
    )
    latest = F.max_by("metric_value", F.struct("version", "metric_value"))
    return (
        versions.groupBy(*SERVING_KEY)
        .agg(latest.alias("metric_value"))
        .select(*SERVING_COLUMNS)
    )


def upsert_serving(
    spark: SparkSession, path: str, updates: DataFrame, work_path: str
) -> None:
    """Upsert into the serving table, rewriting only the days the updates touch.

    The new days are first written in full to `work_path`, a folder of their own. If
    the driver is lost while the days are being swapped, `finish_upsert` repeats the
    swap from there.
    """
    # As many days as the table has folders at most, which the driver lists anyway.
    days = [
        row.day
        for row in updates.select(F.to_date("window_start").alias("day")).distinct().collect()
    ]
    if not days:
        return
    current = _current(spark, path, updates).filter(F.col("day").isin(days))
    _swap(spark, path, upserted(current, updates), current, work_path)


def replace_windows(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    replaced: Column,
    days: tuple[date, date],
    work_path: str,
) -> None:
    """Put `updates` in the place of all rows of the table for which `replaced` holds.

    Only days from the first to the last of `days` are read and rewritten. Rows that are
    neither replaced nor updated stay, whatever their metric or window size; a replaced row
    without an update goes, also if its day is left without rows.
    """
    current = _current(spark, path, updates).filter(F.col("day").between(*days))
    kept = current.filter(~F.coalesce(replaced, F.lit(False)))
    _swap(spark, path, upserted(kept, updates), current, work_path)


def _current(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The table so far; empty if there is none."""
    if names_in(spark, path):
        return spark.read.parquet(path)
    return like.limit(0).select(*SERVING_COLUMNS, F.to_date("window_start").alias("day"))


def _swap(
    spark: SparkSession, path: str, rows: DataFrame, current: DataFrame, work_path: str
) -> None:
    rows.write.mode("overwrite").parquet(f"{work_path}/rows")
    current.select("day").distinct().write.mode("overwrite").parquet(f"{work_path}/days")
    finish_upsert(spark, path, work_path)


def finish_upsert(spark: SparkSession, path: str, work_path: str) -> None:
    """Put the finished days in place; days that have no rows any more become empty."""
    rows = spark.read.parquet(f"{work_path}/rows")
    write_serving(rows, path)
    left = rows.select(F.to_date("window_start").alias("day")).distinct()
    emptied = spark.read.parquet(f"{work_path}/days").join(left, "day", "left_anti")
    days = [row.day for row in emptied.collect()]
    for day in days:
        rows.limit(0).select(*SERVING_COLUMNS).write.mode("overwrite").parquet(f"{path}/day={day}")
    _index(spark, path, days)


def append_serving_jdbc(totals: DataFrame, settings: Settings, table: str = SERVING_TABLE) -> None:
    """Append totals to a database table, in transactions of one partition each."""
    if settings.jdbc_url is None:
        raise ValueError("settings.jdbc_url is not set")
    writer = totals.select(*SERVING_COLUMNS).write.format("jdbc")
    writer = writer.option("url", settings.jdbc_url).option("dbtable", table)
    if settings.jdbc_user is not None:
        writer = writer.option("user", settings.jdbc_user)
    if settings.jdbc_password is not None:
        writer = writer.option("password", settings.jdbc_password)
    writer.option("batchsize", 500).mode("append").save()
