"""Inputs of the registered queries, derived from the given tables.

Each has a twin in SQL. Event times stay TIMESTAMP_NTZ, as in the tables, except where
a stream needs TIMESTAMP.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventtally.functions.parsing import iso_instant
from eventtally.operators.totals import event_totals
from eventtally.sources.topics import ACTIVITY, TRANSACTION


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def activities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as an activity."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        "user_id",
        F.col("event_type").alias("action"),
        F.col("ts").alias("event_time"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases as transactions."""
    purchases = table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    return purchases.select(
        F.col("event_id").alias("id"),
        "user_id",
        F.col("value").alias("amount"),
        F.col("ts").alias("event_time"),
    )


def order_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as transactions."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("event_time"),
    )


def totals(spark: SparkSession, sf_dir: str, size: str = "1 minute") -> DataFrame:
    return event_totals(transactions(spark, sf_dir), activities(spark, sf_dir), size)


ACT = "act AS (SELECT event_id AS id, user_id, event_type AS action, ts AS event_time FROM events)"
TX = (
    "tx AS (SELECT event_id AS id, user_id, value AS amount, ts AS event_time "
    "FROM events WHERE event_type = 'purchase')"
)
DELTAS = """deltas AS (
  SELECT id, 'transaction_count' AS metric_name, 1.0::DOUBLE AS delta, event_time FROM tx
  UNION ALL SELECT id, 'total_transaction_amount', amount, event_time FROM tx
  UNION ALL SELECT id, 'activity_count', 1.0::DOUBLE, event_time FROM act
  UNION ALL SELECT id,
    'activity_count_' || upper(regexp_replace(action, '[^A-Za-z0-9_]', '_', 'g')),
    1.0::DOUBLE, event_time FROM act)"""


def totals_sql(unit: str = "minute", name: str = "totals") -> str:
    return f"""{name} AS (
  SELECT metric_name, sum(delta) AS metric_value,
    date_trunc('{unit}', event_time) AS window_start,
    date_trunc('{unit}', event_time) + INTERVAL 1 {unit} AS window_end
  FROM deltas GROUP BY ALL)"""


WITH_TOTALS = f"WITH {ACT}, {TX}, {DELTAS}, {totals_sql()}"


# Events as JSON text, damaged by rules on event_id; the time of landing is five
# seconds after the event.


def _every(n: int) -> Column:
    return F.col("event_id") % n == 0


def _json(source: str, label: str) -> Column:
    stamp = (
        F.when(_every(89), F.lit("not a time"))
        .when(_every(71), F.date_format("ts", "yyyy-MM-dd"))
        .otherwise(iso_instant(F.col("ts")))
    )
    amount = (
        F.when(_every(83), F.concat(F.lit('"'), F.col("value").cast("string"), F.lit('"')))
        .when(_every(73), F.lit('"n/a"'))
        .otherwise(F.col("value").cast("string"))
    )
    action = F.when(_every(79), F.lit("")).otherwise(
        F.concat(F.lit(', "action": "'), F.col("event_type"), F.lit('"'))
    )
    field = F.concat(F.lit(', "amount": '), amount) if source == TRANSACTION else action
    text = F.concat(
        F.lit('{"type": "'),
        F.lit(label),
        F.lit('", "id": '),
        F.col("event_id").cast("string"),
        field,
        F.lit(', "timestamp": "'),
        stamp,
        F.lit('"'),
    )
    return F.when(_every(97), text).otherwise(F.concat(text, F.lit("}")))


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as raw activity records, purchases as raw transaction records too."""
    events = table(spark, sf_dir, "events")
    landed = (F.col("ts") + F.expr("INTERVAL 5 SECONDS")).alias("ingest_time")
    acts = events.select(
        "event_id", _json(ACTIVITY, ACTIVITY).alias("raw"), landed, F.lit(ACTIVITY).alias("source")
    )
    txs = events.filter(F.col("event_type") == "purchase").select(
        "event_id",
        _json(TRANSACTION, TRANSACTION).alias("raw"),
        landed,
        F.lit(TRANSACTION).alias("source"),
    )
    return acts.unionByName(txs)


def mixed_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed of typed records: purchases, errors of a type nobody knows, activities."""
    events = table(spark, sf_dir, "events")
    raw = (
        F.when(F.col("event_type") == "purchase", _json(TRANSACTION, TRANSACTION))
        .when(F.col("event_type") == "error", _json(ACTIVITY, "alarm"))
        .otherwise(_json(ACTIVITY, ACTIVITY))
    )
    landed = (F.col("ts") + F.expr("INTERVAL 5 SECONDS")).alias("ingest_time")
    return events.select("event_id", raw.alias("raw"), landed)


DIRTY = """ms AS (SELECT *, date_trunc('milliseconds', ts) AS at_ms FROM events),
dirty AS (
  SELECT event_id, 'activity' AS source, event_id % 97 <> 0 AS ok, NULL::DOUBLE AS amount,
    CASE WHEN event_id % 79 = 0 THEN 'UNKNOWN' ELSE event_type END AS action,
    CASE WHEN event_id % 89 = 0 OR event_id % 71 = 0 THEN ts + INTERVAL 5 SECONDS
         ELSE at_ms END AS event_time
  FROM ms
  UNION ALL
  SELECT event_id, 'transaction', event_id % 97 <> 0,
    CASE WHEN event_id % 83 = 0 THEN value WHEN event_id % 73 = 0 THEN 0.0 ELSE value END,
    NULL,
    CASE WHEN event_id % 89 = 0 OR event_id % 71 = 0 THEN ts + INTERVAL 5 SECONDS
         ELSE at_ms END
  FROM ms WHERE event_type = 'purchase')"""


# The time of arrival of an event, up to `jitter` seconds after it.


def arrival(jitter: int) -> Column:
    return F.timestamp_add("SECOND", (F.col("event_id") * 7919 % jitter).cast("int"), F.col("ts"))


# Requests, one per customer, and a snapshot with an entry for each request key.

REQUESTED = [
    "transaction_count",
    "total_transaction_amount",
    "activity_count",
    "activity_count_PURCHASE",
]


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    metric = F.element_at(F.array(*map(F.lit, REQUESTED)), (key % 4 + 1).cast("int"))
    start = F.date_add(F.lit("2024-01-01").cast("date"), (key % 28).cast("int"))
    end = F.date_add(start, (1 + key % 3).cast("int"))
    stamp = "yyyy-MM-dd'T'00:00:00'Z'"
    return table(spark, sf_dir, "customer").select(
        key.alias("request_id"),
        metric.alias("metric_name"),
        F.date_format(start, stamp).alias("start"),
        F.date_format(end, stamp).alias("end"),
    )


REQ = """req AS (
  SELECT c_custkey AS request_id,
    CASE c_custkey % 4 WHEN 0 THEN 'transaction_count' WHEN 1 THEN 'total_transaction_amount'
      WHEN 2 THEN 'activity_count' ELSE 'activity_count_PURCHASE' END AS metric_name,
    TIMESTAMP '2024-01-01' + to_days((c_custkey % 28)::INTEGER) AS lo,
    TIMESTAMP '2024-01-01' + to_days((c_custkey % 28 + 1 + c_custkey % 3)::INTEGER) AS hi
  FROM customer),
reqs AS (
  SELECT request_id, metric_name, strftime(lo, '%Y-%m-%dT%H:%M:%SZ') AS start,
    strftime(hi, '%Y-%m-%dT%H:%M:%SZ') AS "end", lo, hi FROM req)"""

AS_OF = "TIMESTAMP_NTZ '2024-02-01 00:02:00'"


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One entry per request key, stored four seconds apart per day of the start.

    At `AS_OF` those of the first half of the month have expired. Entries of the
    20th are empty. The stored value is the number of requests of the key.
    """
    day = F.substring("start", 9, 2).cast("int")
    stored_at = F.expr("TIMESTAMP_NTZ '2024-02-01 00:00:00'") + F.make_dt_interval(
        secs=(day * 4).cast("double")
    )
    counts = requests(spark, sf_dir).groupBy("metric_name", "start", "end").count()
    return counts.select(
        "metric_name",
        "start",
        "end",
        F.when(day == 20, F.lit("")).otherwise(F.col("count").cast("string")).alias("value"),
        stored_at.alias("cached_at"),
    )


SNAPSHOT = """snap AS (
  SELECT metric_name, start, "end",
    CASE WHEN substr(start, 9, 2) = '20' THEN '' ELSE count(*)::VARCHAR END AS value,
    TIMESTAMP '2024-02-01' + to_seconds(4 * substr(start, 9, 2)::INTEGER) AS cached_at
  FROM reqs GROUP BY metric_name, start, "end"),
live AS (
  SELECT * FROM snap
  WHERE value <> '' AND cached_at + INTERVAL 60 SECONDS > TIMESTAMP '2024-02-01 00:02:00')"""
