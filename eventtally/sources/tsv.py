"""Import of metric files: one `name<TAB>number` per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_metric_lines(spark: SparkSession, path: str) -> DataFrame:
    """All lines of the files in a folder."""
    return spark.read.text(path)


def parse_metric_lines(lines: DataFrame, window_start: Column, window_end: Column) -> DataFrame:
    """Keep lines of exactly two parts and give them the caller's window.

    Tabs at the end of a line do not count as parts. A second part that is not a
    number fails the job, so no half of a file is ever imported.
    """
    parts = F.split(F.regexp_replace("value", "\t+$", ""), "\t")
    kept = lines.select(parts.alias("parts")).filter(F.size("parts") == 2)
    return kept.select(
        F.col("parts")[0].alias("metric_name"),
        F.col("parts")[1].cast("double").alias("metric_value"),
        window_start.alias("window_start"),
        window_end.alias("window_end"),
    )
