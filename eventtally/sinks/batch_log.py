"""Tables that grow by one folder per micro-batch and are folded day by day.

    batches/batch_id=N         the rows of a batch; a batch that runs again replaces its own
    days/upto=U/day=D          all rows of a day up to batch U, folded to one per key
    marks/upto=U               an empty file: the fold up to U is complete

A fold reads the batches since the last mark and the newest generation of the days that occur in
them, and writes new generations of these days only. A reader takes every day's newest marked
generation and the batches after the last mark. What a mark has superseded is deleted by the
fold after it, so a reader has its files for as long as one publish to the next takes.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventtally.config import SERVING_COLUMNS, SERVING_KEY
from eventtally.session import names_in, numbered, remove_folder, set_mark

LOGGED = (
    "metric_name STRING, metric_value DOUBLE, window_start TIMESTAMP, "
    "window_end TIMESTAMP, batch_id BIGINT"
)

NOTHING_FOLDED = -1
ROWS_PER_FILE = 1_000_000

Fold = Callable[[], Column]


def added() -> Column:
    """The value of a key whose rows are partial sums."""
    return F.sum("metric_value")


def newest() -> Column:
    """The value of a key whose rows replace one another."""
    return F.max_by("metric_value", "batch_id")


def folded(log: DataFrame, fold: Fold) -> DataFrame:
    """One row per key, with the last batch that changed it."""
    return log.groupBy(*SERVING_KEY).agg(
        fold().alias("metric_value"), F.max("batch_id").alias("batch_id")
    )


def sum_partials(log: DataFrame) -> DataFrame:
    """Totals from partial sums: the sum of the sums per key."""
    return folded(log, added).select(*SERVING_COLUMNS)


def latest_totals(log: DataFrame) -> DataFrame:
    """Totals from replaced values: the one of the latest batch per key."""
    return folded(log, newest).select(*SERVING_COLUMNS)


def write_gathered(rows: DataFrame, path: str, files: int | None = None) -> None:
    """Replace a folder by rows in as many files as their size asks for, or in a given number."""
    spark = rows.sparkSession
    if files is None and spark.conf.get("spark.sql.adaptive.enabled") == "true":
        rows.hint("rebalance").write.mode("overwrite").parquet(path)
        return
    if files is not None:
        rows.repartition(files).write.mode("overwrite").parquet(path)
        return
    # Streams with state run without adaptive execution: the rows are counted instead.
    kept = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        kept.coalesce(max(1, ceil(kept.count() / ROWS_PER_FILE))).write.mode("overwrite").parquet(path)
    finally:
        kept.unpersist()


def claim(spark: SparkSession, path: str, run: str) -> None:
    """Make a folder the output of one run, named by the stream's own id.

    Batches count from 0 in every run. A new run on an old output would overwrite its
    batches one by one, so it is refused.
    """
    owners = names_in(spark, f"{path}/run")
    if not owners:
        set_mark(spark, f"{path}/run/{run}")
    elif owners != [run]:
        raise ValueError(f"{path} holds the batches of another run; use a folder of its own")


def claimed_by_stream(batch: DataFrame, path: str) -> None:
    """`claim` for the stream that this batch belongs to."""
    spark = batch.sparkSession
    run = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if run:
        claim(spark, path, run)


def append_batch(rows: DataFrame, path: str, batch_id: int, files: int | None = None) -> None:
    """Write the rows of one batch."""
    write_gathered(rows.select(*SERVING_COLUMNS), f"{path}/batches/batch_id={batch_id}", files)


def folded_upto(spark: SparkSession, path: str) -> int:
    return max(numbered(spark, f"{path}/marks", "upto"), default=NOTHING_FOLDED)


def _day_folders(spark: SparkSession, path: str) -> dict[int, list[str]]:
    """The days of each generation, the oldest generation first."""
    root = f"{path}/days"
    return {
        upto: [n for n in names_in(spark, f"{root}/upto={upto}") if n.startswith("day=")]
        for upto in numbered(spark, root, "upto")
    }


def _newest(generations: dict[int, list[str]], mark: int) -> dict[str, int]:
    """The newest generation of every day, of those that a mark covers."""
    return {day: upto for upto, days in generations.items() if upto <= mark for day in days}


def _read(spark: SparkSession, root: str, folders: list[str], base: bool = False) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], LOGGED)
    reader = spark.read.schema(LOGGED)
    reader = reader.option("basePath", root) if base else reader
    return reader.parquet(*(f"{root}/{folder}" for folder in folders))


def _read_days(spark: SparkSession, path: str, days: dict[str, int]) -> DataFrame:
    return _read(spark, f"{path}/days", [f"upto={upto}/{day}" for day, upto in sorted(days.items())])


def _read_batches(spark: SparkSession, path: str, after: int, upto: int | None = None) -> DataFrame:
    numbers = numbered(spark, f"{path}/batches", "batch_id")
    folders = [f"batch_id={n}" for n in numbers if n > after and (upto is None or n <= upto)]
    return _read(spark, f"{path}/batches", folders, base=True)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The newest generation of every day and all batches after the last mark."""
    mark = folded_upto(spark, path)
    days = _newest(_day_folders(spark, path), mark)
    return _read_days(spark, path, days).unionByName(_read_batches(spark, path, mark))


def read_touched(spark: SparkSession, path: str, after: int) -> DataFrame:
    """The folded rows of the days that batches after a given one have touched; no other is read."""
    days = _newest(_day_folders(spark, path), folded_upto(spark, path))
    touched = {day: upto for day, upto in days.items() if upto > after}
    return _read_days(spark, path, touched)


def fold_log(spark: SparkSession, path: str, fold: Fold, upto: int) -> None:
    """Fold the batches up to one into the days that they touch.

    A fold that broke off left no mark and is written anew.
    """
    before = folded_upto(spark, path)
    if upto <= before:
        return
    new = _read_batches(spark, path, before, upto)
    day = F.to_date("window_start")
    # As many days as the table has folders at most, which the driver lists anyway.
    touched = {f"day={row[0]}" for row in new.select(day.cast("string")).distinct().collect()}
    generations = _day_folders(spark, path)
    kept = {d: u for d, u in _newest(generations, before).items() if d in touched}
    (
        folded(_read_days(spark, path, kept).unionByName(new), fold)
        .withColumn("day", day)
        .hint("rebalance", "day")
        .sortWithinPartitions("day", "metric_name", "window_start")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("day")
        .parquet(f"{path}/days/upto={upto}")
    )
    set_mark(spark, f"{path}/marks/upto={upto}")
    _reclaim(spark, path, generations, before)


def _reclaim(spark: SparkSession, path: str, generations: dict[int, list[str]], mark: int) -> None:
    """Delete what a mark has superseded: older generations and marks, and its batches."""
    newest_days = _newest(generations, mark)
    for upto, days in generations.items():
        if upto <= mark:
            old = [day for day in days if newest_days[day] > upto]
            gone = [f"upto={upto}"] if len(old) == len(days) else [f"upto={upto}/{day}" for day in old]
            for folder in gone:
                remove_folder(spark, f"{path}/days/{folder}")
    for number in numbered(spark, f"{path}/batches", "batch_id"):
        if number <= mark:
            remove_folder(spark, f"{path}/batches/batch_id={number}")
    for number in numbered(spark, f"{path}/marks", "upto"):
        if number < mark:
            remove_folder(spark, f"{path}/marks/upto={number}")
