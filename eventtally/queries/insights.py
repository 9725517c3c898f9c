"""Per-user reports, bulk requests, percentiles, throughput, freshness and ratios."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventtally.functions.parsing import iso_instant
from eventtally.operators import bulk, measures, users
from eventtally.operators.percentiles import exact_percentiles
from eventtally.queries import inputs as i
from eventtally.queries.registry import query

PERCENTILES = (0.5, 0.95, 0.99)


def _summary_sql(source: str) -> str:
    return f"""SELECT user_id, count(*) AS n_transactions, round(sum(amount), 2) AS total_amount,
  round(avg(amount), 6) AS avg_amount, min(amount) AS min_amount, max(amount) AS max_amount,
  min(event_time) AS first_at, max(event_time) AS last_at
FROM {source} GROUP BY user_id"""


def _rounded(summary: DataFrame) -> DataFrame:
    return summary.withColumn("total_amount", F.round("total_amount", 2)).withColumn(
        "avg_amount", F.round("avg_amount", 6)
    )


@query(f"WITH {i.TX} {_summary_sql('tx')}")
def user_transaction_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(users.transaction_summary(i.transactions(spark, sf_dir)))


@query(
    "WITH ord AS (SELECT o_custkey AS user_id, o_totalprice AS amount, o_orderdate AS event_time "
    f"FROM orders) {_summary_sql('ord')}"
)
def order_transaction_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(users.transaction_summary(i.order_transactions(spark, sf_dir)))


@query(
    f"""WITH {i.ACT}, counts AS (
  SELECT user_id, action, date_trunc('day', event_time)::TIMESTAMP AS bucket, count(*) AS n
  FROM act GROUP BY ALL)
SELECT *, n - lag(n) OVER (PARTITION BY user_id, action ORDER BY bucket) AS change FROM counts"""
)
def user_activity_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users.activity_trend(i.activities(spark, sf_dir))


def _bulk_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hundred events make a request; errors lack a user and sign-ups a readable time."""
    kind = F.col("event_type")
    activity = F.struct(
        F.col("event_id").cast("int").alias("id"),
        F.when(kind == "error", F.lit(" "))
        .otherwise(F.col("user_id").cast("string"))
        .alias("userId"),
        kind.alias("action"),
        F.when(kind == "signup", F.lit("yesterday"))
        .otherwise(iso_instant(F.col("ts")))
        .alias("timestamp"),
    )
    number = F.floor(F.col("event_id") / 100).cast("bigint").alias("request_id")
    return (
        i.table(spark, sf_dir, "events")
        .groupBy(number)
        .agg(F.collect_list(activity).alias("activities"))
    )


@query(
    """SELECT event_id // 100 AS request_id,
  count(*) FILTER (WHERE event_type NOT IN ('error', 'signup'))::INTEGER AS success_count,
  count(*) FILTER (WHERE event_type IN ('error', 'signup'))::INTEGER AS failure_count
FROM events GROUP BY 1"""
)
def bulk_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bulk.bulk_accounting(_bulk_requests(spark, sf_dir))


@query(
    """SELECT event_id::INTEGER AS id, user_id::VARCHAR AS user_id, event_type AS action,
  date_trunc('milliseconds', ts) AS event_time
FROM events WHERE event_type NOT IN ('error', 'signup')"""
)
def bulk_activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = bulk.bulk_activities(_bulk_requests(spark, sf_dir))
    return taken.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


@query(
    """SELECT event_type, 0.5::DOUBLE AS percentile, quantile_disc(value, 0.5) AS value
FROM events GROUP BY event_type
UNION ALL SELECT event_type, 0.95, quantile_disc(value, 0.95) FROM events GROUP BY event_type
UNION ALL SELECT event_type, 0.99, quantile_disc(value, 0.99) FROM events GROUP BY event_type"""
)
def latency_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = i.table(spark, sf_dir, "events")
    return exact_percentiles(events, ["event_type"], "value", PERCENTILES)


@query(
    """SELECT date_trunc('hour', ts) AS window_start, count(*) AS n_events,
  round(count(*) / 3600.0::DOUBLE, 8) AS events_per_second
FROM events GROUP BY 1"""
)
def throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = measures.throughput(i.activities(spark, sf_dir))
    return rates.withColumn("events_per_second", F.round("events_per_second", 8))


@query(
    """SELECT count(*) AS n_events, min(ts) AS first_at, max(ts) AS last_at,
  round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 3) AS seconds,
  round(count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6), 8) AS events_per_second
FROM events"""
)
def overall_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    rate = measures.overall_throughput(i.activities(spark, sf_dir))
    return rate.withColumn("seconds", F.round("seconds", 3)).withColumn(
        "events_per_second", F.round("events_per_second", 8)
    )


@query(
    """WITH lags AS (
  SELECT event_id AS id, 'activity_count' AS metric_name, ts AS event_time,
    date_trunc('minute', ts) AS window_start,
    (epoch_us(date_trunc('minute', ts) + INTERVAL 91 SECONDS
      + to_seconds(2 * minute(ts))) - epoch_us(ts)) / 1e6 AS lag_seconds
  FROM events)
SELECT *, lag_seconds <= 120 AS visible FROM lags"""
)
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = i.activities(spark, sf_dir).select(
        "id", F.lit("activity_count").alias("metric_name"), "event_time"
    )
    # Readable 31 seconds after the window, and later towards the end of each hour.
    delay = F.make_dt_interval(secs=(F.minute("window_start") * 2 + 31).cast("double"))
    committed = i.totals(spark, sf_dir).withColumn("committed_at", F.col("window_end") + delay)
    return measures.freshness(asked, committed, spread_by=["id"])


@query(
    """SELECT date_trunc('hour', ts) AS window_start, count(*) AS n_events,
  count(*) FILTER (WHERE event_type = 'error') AS n_flagged,
  round(avg((event_type = 'error')::INTEGER), 6) AS ratio
FROM events GROUP BY 1"""
)
def ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = measures.ratio(i.activities(spark, sf_dir), F.col("action") == "error")
    return shares.withColumn("ratio", F.round("ratio", 6))


TAIL = (0.1, 0.5, 0.9, 0.999)


@query(
    f"""WITH heavy AS (SELECT event_type, value * value * value * value * value AS x FROM events WHERE value IS NOT NULL),
ranked AS (
  SELECT event_type, x, row_number() OVER (PARTITION BY event_type ORDER BY x) AS r,
    count(*) OVER (PARTITION BY event_type) AS n FROM heavy)
SELECT event_type, p::DOUBLE AS percentile, x AS value
FROM ranked, unnest([{", ".join(map(str, TAIL))}]) t(p) WHERE r = greatest(1, ceil(round(p * n, 6)))"""
)
def percentiles_heavy_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most values bunched at one end of a wide range; slots are cut down to a few values."""
    x = F.col("value")
    rows = i.table(spark, sf_dir, "events").select("event_type", (x * x * x * x * x).alias("x"))
    return exact_percentiles(rows, ["event_type"], "x", TAIL, last_cut=8)


GAPS = (0.01, 0.5, 0.99, 1.0)


@query(
    f"""WITH measured AS (
  SELECT CASE WHEN event_type <> 'error' THEN event_type END AS kind,
    CASE WHEN event_id % 97 = 0 THEN 'infinity'::DOUBLE WHEN event_id % 89 = 0 THEN '-infinity'::DOUBLE
      WHEN event_id % 83 = 0 THEN 'nan'::DOUBLE WHEN event_id % 79 = 0 THEN NULL ELSE value END AS x
  FROM events),
ranked AS (
  SELECT kind, x, row_number() OVER (PARTITION BY kind ORDER BY x) AS r, count(*) OVER (PARTITION BY kind) AS n
  FROM measured WHERE x IS NOT NULL)
SELECT kind, p::DOUBLE AS percentile, x AS value
FROM ranked, unnest([{", ".join(map(str, GAPS))}]) t(p) WHERE r = greatest(1, ceil(round(p * n, 6)))"""
)
def percentiles_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A group without a name, infinities, NaN and missing values."""
    at = F.col("event_id")
    value = (
        F.when(at % 97 == 0, F.lit(float("inf")))
        .when(at % 89 == 0, F.lit(float("-inf")))
        .when(at % 83 == 0, F.lit(float("nan")))
        .when(at % 79 == 0, F.lit(None))
        .otherwise(F.col("value"))
    )
    kind = F.when(F.col("event_type") != "error", F.col("event_type"))
    rows = i.table(spark, sf_dir, "events").select(kind.alias("kind"), value.alias("x"))
    return exact_percentiles(rows, ["kind"], "x", GAPS)
