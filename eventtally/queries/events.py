"""Reading, routing, storing and publishing events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventtally.config import ACTIVITIES_DLQ_TOPIC, TRANSACTIONS_DLQ_TOPIC, Settings
from eventtally.functions.parsing import iso_instant, required_instant
from eventtally.operators import events as ev
from eventtally.operators.deltas import event_deltas
from eventtally.operators.totals import window_totals
from eventtally.plans.ingest import ingest_batch
from eventtally.queries import inputs as i
from eventtally.queries.registry import query
from eventtally.queries.totals import rounded
from eventtally.session import shared_folder
from eventtally.sinks.dead_letters import dead_letters as unreadable
from eventtally.sinks.dead_letters import start_dead_letter_topics
from eventtally.sinks.serving import upsert_serving
from eventtally.sinks.topic_files import read_topic
from eventtally.sources.serving import read_serving
from eventtally.sources.topics import TRANSACTION, as_source, stored_topic
from eventtally.sources.tsv import parse_metric_lines, read_metric_lines
from eventtally.streaming.late_capture import start_capture


def _parsed(spark: SparkSession, sf_dir: str, keep: list[str] | None = None) -> DataFrame:
    raw = i.dirty(spark, sf_dir)
    return ev.parse_events(raw.withColumn("ingest_time", F.col("ingest_time").cast("timestamp")), keep)


def _ntz(rows: DataFrame, *columns: str) -> DataFrame:
    for column in columns:
        rows = rows.withColumn(column, F.col(column).cast("timestamp_ntz"))
    return rows


@query(f"WITH {i.DIRTY} SELECT event_id, source, amount, action, event_time FROM dirty WHERE ok")
def json_parse_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = _parsed(spark, sf_dir, keep=["event_id"]).filter(F.col("reason").isNull())
    return _ntz(parsed.select("event_id", "source", "amount", "action", "event_time"), "event_time")


@query(
    """SELECT event_id, 'activity' AS source, 'malformed' AS reason FROM events
WHERE event_id % 97 = 0
UNION ALL SELECT event_id, 'transaction', 'malformed' FROM events
WHERE event_id % 97 = 0 AND event_type = 'purchase'"""
)
def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    letters = unreadable(_parsed(spark, sf_dir))
    number = F.regexp_extract("raw", '"id": ([0-9]+)', 1).cast("bigint")
    return letters.select(number.alias("event_id"), "source", "reason")


@query(
    """SELECT event_id, 'events.activities.dlq' AS topic, 'malformed' AS key FROM events
WHERE event_id % 97 = 0
UNION ALL SELECT event_id, 'events.transactions.dlq', 'malformed' FROM events
WHERE event_id % 97 = 0 AND event_type = 'purchase'"""
)
def dead_letter_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unreadable records of a capture, streamed on to the topics of their sources and read back."""
    folder = shared_folder(spark, "letters")
    raw = i.dirty(spark, sf_dir).withColumn("ingest_time", F.col("ingest_time").cast("timestamp"))
    raw.drop("event_id").write.parquet(f"{folder}/topic")
    stream = spark.readStream.schema("raw STRING, ingest_time TIMESTAMP, source STRING").parquet(f"{folder}/topic")
    start_capture(stream, f"{folder}/out", f"{folder}/checkpoint", available_now=True).awaitTermination()
    start_dead_letter_topics(
        spark, f"{folder}/out/dead_letters", f"{folder}/topics", f"{folder}/letters-checkpoint", available_now=True
    ).awaitTermination()
    number = F.regexp_extract("value", '"id": ([0-9]+)', 1).cast("bigint").alias("event_id")
    kinds = [
        read_topic(spark, f"{folder}/topics", topic).select(number, F.lit(topic).alias("topic"), "key")
        for topic in (TRANSACTIONS_DLQ_TOPIC, ACTIVITIES_DLQ_TOPIC)
    ]
    return kinds[0].unionByName(kinds[1])


@query(
    """SELECT CASE WHEN event_id % 97 = 0 THEN 'malformed' WHEN event_type = 'error' THEN 'alarm'
    WHEN event_type = 'purchase' THEN 'transaction' ELSE 'activity' END AS kind,
  CASE WHEN event_id % 97 = 0 THEN 'malformed' WHEN event_type = 'error' THEN 'unknown_type' END
    AS reason,
  count(*) AS n_events, count(*) FILTER (WHERE event_id % 97 <> 0 AND event_type = 'purchase')
    AS n_amounts
FROM events GROUP BY 1, 2"""
)
def event_router(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = ev.route_events(i.mixed_feed(spark, sf_dir))
    parsed = ev.parse_events(feed)
    return parsed.groupBy(
        F.coalesce("source", "reason").alias("kind"), "reason"
    ).agg(F.count(F.lit(1)).alias("n_events"), F.count("amount").alias("n_amounts"))


@query(
    f"""WITH {i.DIRTY}, deltas AS (
  SELECT CASE source WHEN 'transaction' THEN 'transaction_count' ELSE 'activity_count' END
    AS metric_name, 1.0::DOUBLE AS delta, event_time FROM dirty WHERE ok
  UNION ALL
  SELECT CASE source WHEN 'transaction' THEN 'total_transaction_amount'
      ELSE 'activity_count_' || upper(action) END,
    CASE source WHEN 'transaction' THEN amount ELSE 1.0 END, event_time FROM dirty WHERE ok),
{i.totals_sql()}
SELECT metric_name, round(metric_value, 4) AS metric_value, window_start, window_end FROM totals"""
)
def dirty_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = window_totals(event_deltas(_parsed(spark, sf_dir)))
    return rounded(_ntz(totals, "window_start", "window_end"))


def wire_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases in the layout they arrive in."""
    return i.transactions(spark, sf_dir).select(
        "id",
        F.concat(F.lit("purchase of "), F.col("user_id").cast("string")).alias("description"),
        "amount",
        F.lit("USD").alias("currency"),
        F.lit("SUCCESS").alias("status"),
        iso_instant(F.col("event_time")).alias("timestamp"),
        F.col("event_time").cast("timestamp").alias("ingest_time"),
    )


def _ingest(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    folder = shared_folder(spark, "ingest")
    ingest_batch(
        wire_transactions(spark, sf_dir),
        0,
        TRANSACTION,
        f"{folder}/raw",
        Settings(publish_enabled=True),
        f"{folder}/topic",
    )
    return f"{folder}/raw", f"{folder}/topic"


@query(
    f"""WITH {i.TX}
SELECT id::VARCHAR AS key, amount, date_trunc('milliseconds', event_time) AS event_time FROM tx"""
)
def publish_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, topic = _ingest(spark, sf_dir)
    records = stored_topic(spark, topic).withColumnRenamed("value", "raw")
    parsed = ev.parse_events(as_source(records, TRANSACTION), keep=["key"])
    return _ntz(parsed.select("key", "amount", "event_time"), "event_time")


@query(
    f"""WITH {i.TX}
SELECT id AS event_id, 'purchase of ' || user_id AS description, amount, 'USD' AS currency,
  'SUCCESS' AS status, event_time, event_time::DATE AS ingest_date FROM tx"""
)
def raw_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, _ = _ingest(spark, sf_dir)
    # The stored text is read back as an instant only to be compared.
    at = F.col("timestamp").cast("timestamp").cast("timestamp_ntz")
    return spark.read.parquet(raw).select(
        "event_id",
        "description",
        "amount",
        "currency",
        "status",
        at.alias("event_time"),
        "ingest_date",
    )


@query(
    f"""WITH {i.TX}
SELECT id::VARCHAR AS "transactionId", user_id::VARCHAR AS "userId",
  amount::DECIMAL(18,2) AS amount, 'USD' AS currency, 'SUCCESS' AS status,
  date_trunc('milliseconds', event_time) AS timestamp FROM tx"""
)
def canonical_dto(spark: SparkSession, sf_dir: str) -> DataFrame:
    wire = i.transactions(spark, sf_dir).select(
        "id",
        "user_id",
        "amount",
        F.lit("USD").alias("currency"),
        F.lit("SUCCESS").alias("status"),
        F.unix_millis(F.col("event_time").cast("timestamp")).alias("timestamp_ms"),
    )
    return _ntz(ev.canonical_transactions(wire), "timestamp")


@query(
    """SELECT event_id::VARCHAR AS "activityId", user_id::VARCHAR AS "userId",
  event_type AS "activityType", props AS metadata,
  date_trunc('milliseconds', ts) AS timestamp FROM events"""
)
def canonical_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    wire = i.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        "user_id",
        F.col("event_type").alias("activity"),
        F.col("props").alias("metadata"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp_ms"),
    )
    return _ntz(ev.canonical_activities(wire), "timestamp")


@query(
    f"""{i.WITH_TOTALS}
SELECT CASE WHEN minute(window_start) = 8 THEN '' ELSE metric_name END AS metric_name,
  round(metric_value, 2) AS metric_value,
  TIMESTAMP '2024-01-01' AS window_start, TIMESTAMP '2024-02-01' AS window_end
FROM totals WHERE minute(window_start) NOT IN (5, 6, 9)"""
)
def tsv_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ntz(_imported_lines(spark, sf_dir), "window_start", "window_end")


def _imported_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = i.totals(spark, sf_dir)
    name = F.col("metric_name")
    value = F.round("metric_value", 2).cast("string")
    at = F.minute("window_start")
    tab = F.lit("\t")
    # Minute 5: three parts. 6: no number. 7: tabs at the end. 8: no name. 9: one part.
    line = (
        F.when(at == 5, F.concat(name, tab, value, tab, F.lit("x")))
        .when(at == 6, F.concat(name, tab))
        .when(at == 7, F.concat(name, tab, value, tab, tab))
        .when(at == 8, F.concat(tab, value))
        .when(at == 9, name)
        .otherwise(F.concat(name, tab, value))
    )
    folder = shared_folder(spark, "tsv")
    totals.select(line.alias("value")).write.text(folder)
    return parse_metric_lines(
        read_metric_lines(spark, folder),
        required_instant(F.lit("2024-01-01T00:00:00Z")),
        required_instant(F.lit("2024-02-01T00:00:00Z")),
    )


@query(
    f"""{i.WITH_TOTALS}
SELECT CASE WHEN minute(window_start) = 8 THEN '' ELSE metric_name END AS metric_name,
  max(round(metric_value, 2)) AS metric_value,
  TIMESTAMP '2024-01-01' AS window_start, TIMESTAMP '2024-02-01' AS window_end
FROM totals WHERE minute(window_start) NOT IN (5, 6, 9) GROUP BY 1"""
)
def tsv_served(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines in the serving table, imported twice; of lines of one metric the largest stays."""
    path = shared_folder(spark, "serving")
    for _ in range(2):
        upsert_serving(spark, path, _imported_lines(spark, sf_dir), shared_folder(spark, "import"))
    return _ntz(read_serving(spark, path).drop("day"), "window_start", "window_end")
