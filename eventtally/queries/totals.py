"""Deltas, window totals, rollups and backfill."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventtally.config import Settings
from eventtally.operators import deltas as dl
from eventtally.operators import totals as tt
from eventtally.plans.backfill import backfill, recomputed_totals
from eventtally.queries import inputs as i
from eventtally.queries.registry import query
from eventtally.session import shared_folder
from eventtally.sinks.serving import write_serving
from eventtally.sources.serving import read_serving


def rounded(totals: DataFrame, column: str = "metric_value") -> DataFrame:
    return totals.withColumn(column, F.round(column, 4))


TOTALS_OUT = """SELECT metric_name, round(metric_value, 4) AS metric_value, window_start, window_end
FROM totals"""


@query(f"{i.WITH_TOTALS} {TOTALS_OUT}")
def tumbling_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(i.totals(spark, sf_dir))


@query(f"{i.WITH_TOTALS} {TOTALS_OUT}")
def tumbling_metrics_from_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    deltas = dl.all_deltas(
        dl.transaction_deltas(i.transactions(spark, sf_dir)),
        dl.activity_deltas(i.activities(spark, sf_dir)),
    )
    return rounded(tt.window_totals(deltas))


@query(
    """SELECT 'transaction_count' AS metric_name, count(*)::DOUBLE AS metric_value,
  o_orderdate AS window_start, o_orderdate + INTERVAL 1 DAY AS window_end
FROM (SELECT date_trunc('day', o_orderdate)::TIMESTAMP AS o_orderdate FROM orders) GROUP BY ALL
UNION ALL
SELECT 'total_transaction_amount', round(sum(o_totalprice), 2),
  o_orderdate, o_orderdate + INTERVAL 1 DAY
FROM (SELECT date_trunc('day', o_orderdate)::TIMESTAMP AS o_orderdate, o_totalprice FROM orders)
GROUP BY o_orderdate"""
)
def order_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = tt.transaction_totals(i.order_transactions(spark, sf_dir), "1 day")
    return totals.withColumn("metric_value", F.round("metric_value", 2))


@query(
    """SELECT event_id,
  'activity_count_' || upper(regexp_replace(event_type || ' ' || props, '[^A-Za-z0-9_]', '_', 'g'))
    AS metric_name
FROM events"""
)
def activity_metric_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return i.table(spark, sf_dir, "events").select(
        "event_id",
        dl.action_metric(F.concat_ws(" ", "event_type", "props")).alias("metric_name"),
    )


@query(
    f"""WITH {i.TX}
SELECT id, 'transaction_count' AS metric_name, 1.0::DOUBLE AS delta, event_time FROM tx
UNION ALL SELECT id, 'total_transaction_amount', amount, event_time FROM tx"""
)
def transaction_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dl.transaction_deltas(i.transactions(spark, sf_dir), keep=["id"])


@query(
    f"""WITH {i.ACT}
SELECT id, 'activity_count' AS metric_name, 1.0::DOUBLE AS delta, event_time FROM act
UNION ALL SELECT id, 'activity_count_' || upper(action), 1.0::DOUBLE, event_time FROM act"""
)
def activity_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dl.activity_deltas(i.activities(spark, sf_dir), keep=["id"])


@query(f"{i.WITH_TOTALS} {TOTALS_OUT} WHERE metric_name LIKE 'activity_count%'")
def merged_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    acts = i.activities(spark, sf_dir)
    bought = F.col("action") == "purchase"
    return rounded(
        tt.merged_totals(
            tt.activity_totals(acts.filter(bought)), tt.activity_totals(acts.filter(~bought))
        )
    )


def _rollup_sql(unit: str) -> str:
    return f"""{i.WITH_TOTALS}
SELECT metric_name, round(sum(metric_value), 4) AS metric_value,
  date_trunc('{unit}', window_start)::TIMESTAMP AS window_start,
  date_trunc('{unit}', window_start)::TIMESTAMP + INTERVAL 1 {unit} AS window_end
FROM totals GROUP BY metric_name, date_trunc('{unit}', window_start)"""


@query(_rollup_sql("hour"))
def rollup_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tt.rollup_totals(i.totals(spark, sf_dir), "1 hour"))


@query(_rollup_sql("day"))
def rollup_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tt.rollup_totals(i.totals(spark, sf_dir), "1 day"))


@query(f"{_rollup_sql('hour')} UNION ALL ({_rollup_sql('day')})")
def rollup_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours and days from one pass over the totals of minutes."""
    return rounded(tt.rollup_levels(i.totals(spark, sf_dir), ["1 hour", "1 day"]))


@query(
    f"""{i.WITH_TOTALS} {TOTALS_OUT}
WHERE window_end + INTERVAL 30 SECONDS <= (SELECT max(ts) FROM events)"""
)
def closed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = i.table(spark, sf_dir, "events").agg(F.max("ts")).scalar()
    settings = Settings()
    return rounded(
        tt.closed_totals(i.totals(spark, sf_dir), newest, settings.out_of_orderness_seconds)
    )


@query(
    f"""{i.WITH_TOTALS} {TOTALS_OUT}
WHERE window_start >= TIMESTAMP '2024-01-08' AND window_start < TIMESTAMP '2024-01-15'"""
)
def backfill_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        recomputed_totals(
            i.transactions(spark, sf_dir),
            i.activities(spark, sf_dir),
            "2024-01-08T00:00:00Z",
            "2024-01-15T00:00:00Z",
        )
    )


EMPTIED = "2024-01-10"


@query(
    f"""{i.WITH_TOTALS}, days AS (
  SELECT metric_name, sum(metric_value) AS metric_value,
    date_trunc('day', window_start)::TIMESTAMP AS window_start,
    date_trunc('day', window_start)::TIMESTAMP + INTERVAL 1 DAY AS window_end
  FROM totals GROUP BY metric_name, date_trunc('day', window_start))
SELECT metric_name, CASE WHEN window_start >= TIMESTAMP '2024-01-08' AND window_start < TIMESTAMP '2024-01-15'
    THEN round(metric_value, 4) ELSE -1 END AS metric_value, window_start, window_end
FROM totals WHERE window_start::DATE <> DATE '{EMPTIED}'
UNION ALL SELECT metric_name, round(metric_value, 4), window_start, window_end FROM days
UNION ALL SELECT 'imported', 7, TIMESTAMP '2024-01-09', TIMESTAMP '2024-01-09 00:01:00'"""
)
def backfill_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of wrong totals, day rollups and an imported metric, after a backfill of a week
    in which one day has no events any more."""
    path = shared_folder(spark, "serving")
    totals = i.totals(spark, sf_dir)
    at = F.expr("TIMESTAMP_NTZ '2024-01-09 00:00:00'")
    imported = spark.range(1).select(
        F.lit("imported").alias("metric_name"),
        F.lit(7.0).alias("metric_value"),
        at.alias("window_start"),
        (at + F.expr("INTERVAL 1 minute")).alias("window_end"),
    )
    wrong = totals.withColumn("metric_value", F.lit(-1.0))
    write_serving(wrong.unionByName(tt.rollup_totals(totals, "1 day")).unionByName(imported), path)
    left = F.to_date("event_time") != F.lit(EMPTIED).cast("date")
    backfill(
        spark,
        i.transactions(spark, sf_dir).filter(left),
        i.activities(spark, sf_dir).filter(left),
        "2024-01-08T00:00:00Z",
        "2024-01-15T00:00:00Z",
        path,
    )
    return rounded(read_serving(spark, path).drop("day"))
