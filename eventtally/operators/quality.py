"""Checks on the serving table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventtally.config import MAX_METRIC_NAME, SERVING_COLUMNS, SERVING_KEY, SERVING_TABLE


def missing_columns(columns: list[str], required: list[str] = SERVING_COLUMNS) -> list[str]:
    found = {c.lower() for c in columns}
    return [c for c in required if c.lower() not in found]


def require_schema(totals: DataFrame, enabled: bool = True) -> DataFrame:
    """The frame itself if it has all serving columns, in any letter case."""
    missing = missing_columns(totals.columns) if enabled else []
    if missing:
        raise ValueError(
            f"Aggregate schema validation failed for {SERVING_TABLE}: missing {missing}"
        )
    return totals


def require_table(
    spark: SparkSession, table: str = SERVING_TABLE, enabled: bool = True
) -> DataFrame:
    """A catalog table that must exist and have all serving columns."""
    if enabled and not spark.catalog.tableExists(table):
        raise ValueError(
            f"Aggregate schema validation failed for {SERVING_TABLE}: missing table {table}"
        )
    return require_schema(spark.table(table), enabled)


def schema_report(totals: DataFrame) -> DataFrame:
    """One row per required column: is it there, and how many rows carry a value."""
    actual = {c.lower(): c for c in totals.columns}
    counts = totals.agg(
        *[
            (F.count(F.col(actual[c])) if c in actual else F.lit(0).cast("bigint")).alias(c)
            for c in SERVING_COLUMNS
        ]
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(c in actual).alias("found"),
            F.col(c).alias("filled_rows"),
        )
        for c in SERVING_COLUMNS
    ]
    return counts.select(F.inline(F.array(*rows)))


def constraint_rules() -> dict[str, Column]:
    """What must not be true of a row, by rule name."""
    value = F.col("metric_value")
    return {
        "metric_name_null": F.col("metric_name").isNull(),
        "metric_name_too_long": F.length("metric_name") > MAX_METRIC_NAME,
        "metric_value_null": value.isNull(),
        "metric_value_not_finite": F.isnan(value) | (F.abs(value) == float("inf")),
        "window_start_null": F.col("window_start").isNull(),
        "window_end_null": F.col("window_end").isNull(),
        "window_not_positive": F.col("window_end") <= F.col("window_start"),
    }


def constraint_violations(totals: DataFrame) -> DataFrame:
    """Rows against each rule, counted in one pass."""
    rules = constraint_rules()
    counts = totals.agg(*[F.count_if(broken).alias(name) for name, broken in rules.items()])
    rows = [
        F.struct(F.lit(name).alias("rule"), F.col(name).alias("violations")) for name in rules
    ]
    return counts.select(F.inline(F.array(*rows)))


def _broken() -> Column:
    broken = F.lit(False)
    for rule in constraint_rules().values():
        broken = broken | F.coalesce(rule, F.lit(False))
    return broken


def accepted(totals: DataFrame) -> DataFrame:
    """Rows that break no rule."""
    return totals.filter(~_broken())


def quarantined(totals: DataFrame) -> DataFrame:
    """Rows that break a rule, with the names of the rules."""
    names = [
        F.when(F.coalesce(broken, F.lit(False)), F.lit(name))
        for name, broken in constraint_rules().items()
    ]
    return totals.filter(_broken()).withColumn("rules", F.array_compact(F.array(*names)))


def duplicate_keys(totals: DataFrame) -> DataFrame:
    """Keys that occur more than once."""
    return (
        totals.groupBy(*SERVING_KEY)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )
