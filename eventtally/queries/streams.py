"""Streaming jobs over the given tables, run until their input is used up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventtally.config import Settings
from eventtally.operators import measures
from eventtally.operators.deltas import (
    activity_deltas,
    all_deltas,
    event_deltas,
    transaction_deltas,
)
from eventtally.operators.events import parse_events
from eventtally.operators.lateness import split_totals
from eventtally.operators.lookup import range_totals
from eventtally.operators.reconcile import reconcile_by_day
from eventtally.operators.totals import event_totals
from eventtally.plans.replay import replayed_deltas
from eventtally.queries import inputs as i
from eventtally.queries.registry import query
from eventtally.queries.totals import TOTALS_OUT, rounded
from eventtally.session import shared_folder
from eventtally.sinks.batch_log import latest_totals, read_log
from eventtally.sinks.serving import write_serving
from eventtally.sources.serving import read_committed, read_serving
from eventtally.streaming.late_capture import (
    captured_late_rows,
    captured_totals,
    start_capture,
)
from eventtally.streaming.totals import open_windows, start_totals

SLICES = 4
RECORDED = Settings(record_batches=True)
JITTER = 172_800


def _ntz(rows: DataFrame, *columns: str) -> DataFrame:
    for column in columns:
        rows = rows.withColumn(column, F.col(column).cast("timestamp_ntz"))
    return rows


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = i.table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*")
    return events.withColumn("event_time", F.col("ts").cast("timestamp"))


@query(f"{i.WITH_TOTALS} {TOTALS_OUT}")
def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _event_stream(spark, sf_dir)
    purchases = events.filter(F.col("event_type") == "purchase")
    deltas = all_deltas(
        transaction_deltas(purchases.withColumn("amount", F.col("value"))),
        activity_deltas(events.withColumn("action", F.col("event_type"))),
    )
    folder = shared_folder(spark, "stream")
    start_totals(
        deltas, f"{folder}/log", f"{folder}/checkpoint", Settings(), available_now=True
    ).awaitTermination()
    totals = latest_totals(read_log(spark, f"{folder}/log"))
    return rounded(_ntz(totals, "window_start", "window_end"))


def _sliced(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """The events as raw records, in slices of their arrival time."""
    events = i.table(spark, sf_dir, "events").withColumn("arrival", i.arrival(JITTER))
    at = F.unix_millis(F.col("arrival").cast("timestamp"))
    span = events.agg(F.struct(F.min(at).alias("low"), F.max(at).alias("high"))).scalar()
    low, high = span["low"], span["high"]
    part = F.least(F.lit(SLICES - 1), F.floor((at - low) * SLICES / (high - low))).cast("int")
    kinds = F.when(
        F.col("event_type") == "purchase", F.array(F.lit("transaction"), F.lit("activity"))
    ).otherwise(F.array(F.lit("activity")))
    body = F.to_json(
        F.struct(
            F.col("event_id").alias("id"),
            F.col("event_type").alias("action"),
            F.col("value").alias("amount"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        )
    )
    (
        events.withColumn("part", part)
        .withColumn("source", F.explode(kinds))
        .select(body.alias("raw"), F.col("arrival").cast("timestamp").alias("ingest_time"), "source", "part")
        .write.partitionBy("part")
        .parquet(f"{folder}/sliced")
    )


def _fed(spark: SparkSession, sf_dir: str, folder: str, start, landed: Column | None = None) -> None:
    """Feed the slices one by one, a micro-batch each.

    `start` starts a job over the stream of raw records. The job is started anew for every slice
    and goes on from its checkpoint. `landed` takes the place of the recorded time of arrival.
    """
    landed = F.col("ingest_time") if landed is None else landed
    _sliced(spark, sf_dir, folder)
    schema = "raw STRING, ingest_time TIMESTAMP, source STRING"
    for number in range(SLICES):
        spark.read.schema(schema).parquet(f"{folder}/sliced/part={number}").write.parquet(
            f"{folder}/topic/slice={number}"
        )
        raw = spark.readStream.schema(schema).parquet(f"{folder}/topic")
        start(raw.select("raw", landed.alias("ingest_time"), "source")).awaitTermination()


def captured(
    spark: SparkSession,
    sf_dir: str,
    serving_path: str | None = None,
    settings: Settings = Settings(),
    rollups: Sequence[str] = (),
    landed: Column | None = None,
) -> str:
    folder = shared_folder(spark, "capture")

    def start(raw: DataFrame):
        return start_capture(
            raw,
            f"{folder}/out",
            f"{folder}/checkpoint",
            settings,
            available_now=True,
            serving_path=serving_path,
            publish_every=3,
            rollups=rollups,
        )

    _fed(spark, sf_dir, folder, start, landed)
    return f"{folder}/out"


def _aggregated(spark: SparkSession, sf_dir: str, **options) -> str:
    """The folder of the job with built-in state, after all slices."""
    folder = shared_folder(spark, "totals")

    def start(raw: DataFrame):
        deltas = event_deltas(parse_events(raw))
        return start_totals(
            deltas, f"{folder}/log", f"{folder}/checkpoint", Settings(), available_now=True, **options
        )

    _fed(spark, sf_dir, folder, start)
    return folder


def _logged(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    totals = latest_totals(read_log(spark, f"{_aggregated(spark, sf_dir, **options)}/log"))
    return rounded(_ntz(totals, "window_start", "window_end"))


def capture_sql(delay_ms: int = 60_000) -> str:
    return f"""WITH {i.ACT}, {i.TX}, {i.DELTAS},
arrivals AS (
  SELECT d.metric_name, d.delta, date_trunc('milliseconds', d.event_time) AS event_time,
    epoch_ms(e.ts + to_seconds((e.event_id * 7919) % {JITTER})) AS arrived_ms,
    e.ts + to_seconds((e.event_id * 7919) % {JITTER}) AS arrival
  FROM deltas d JOIN events e ON e.event_id = d.id),
bounds AS (SELECT min(arrived_ms) AS low, max(arrived_ms) AS high FROM arrivals),
sliced AS (
  SELECT a.*, least({SLICES - 1}, floor((arrived_ms - low) * {SLICES}::DOUBLE / (high - low)))::BIGINT
    AS batch_id
  FROM arrivals a, bounds),
tops AS (SELECT batch_id, max(epoch_ms(event_time)) AS top FROM sliced GROUP BY batch_id),
judged AS (
  SELECT s.*, date_trunc('minute', event_time) AS window_start,
    coalesce(epoch_ms(date_trunc('minute', event_time) + INTERVAL 1 MINUTE) + {delay_ms} <=
      (SELECT max(top) FROM tops t WHERE t.batch_id < s.batch_id), false) AS late
  FROM sliced s)"""


CAPTURE = capture_sql()


@query(
    f"""{CAPTURE}
SELECT metric_name, delta AS delta_value, event_time, arrival AS ingested_at, batch_id
FROM judged WHERE late"""
)
def stream_late_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = captured_late_rows(spark, captured(spark, sf_dir))
    return _ntz(late, "event_time", "ingested_at")


@query(
    f"""{CAPTURE}
SELECT metric_name, round(sum(delta), 4) AS metric_value, window_start,
  window_start + INTERVAL 1 MINUTE AS window_end
FROM judged WHERE NOT late GROUP BY metric_name, window_start"""
)
def stream_ledger_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = captured_totals(spark, captured(spark, sf_dir))
    return rounded(_ntz(totals, "window_start", "window_end"))


@query(
    f"""{CAPTURE}
SELECT metric_name, round(sum(delta), 4) AS metric_value, window_start,
  window_start + INTERVAL 1 MINUTE AS window_end
FROM judged WHERE NOT late GROUP BY metric_name, window_start"""
)
def stream_metrics_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late rows of later slices are dropped; open windows go on over restarts."""
    return _logged(spark, sf_dir)


@query(
    f"""{CAPTURE}
SELECT metric_name, round(sum(delta), 4) AS metric_value, window_start,
  window_start + INTERVAL 1 MINUTE AS window_end
FROM judged WHERE NOT late
  AND epoch_ms(window_start + INTERVAL 1 MINUTE) + 60000 <= (SELECT max(top) FROM tops)
GROUP BY metric_name, window_start"""
)
def stream_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only windows that the watermark has passed, each written once."""
    return _logged(spark, sf_dir, closed_only=True)


@query(
    f"""{CAPTURE}
SELECT metric_name, round(sum(delta), 4) AS metric_value, window_start,
  window_start + INTERVAL 1 MINUTE AS window_end
FROM judged WHERE NOT late
  AND epoch_ms(window_start + INTERVAL 1 MINUTE) + 60000 > (SELECT max(top) FROM tops)
GROUP BY metric_name, window_start"""
)
def stream_open_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the job still holds as state after the last slice, read from its checkpoint."""
    folder = _aggregated(spark, sf_dir)
    return rounded(_ntz(open_windows(spark, f"{folder}/checkpoint"), "window_start", "window_end"))


@query(
    f"""{CAPTURE}
SELECT metric_name, round(sum(delta), 4) AS metric_value, window_start,
  window_start + INTERVAL 1 MINUTE AS window_end
FROM judged WHERE NOT late GROUP BY metric_name, window_start"""
)
def stream_state_served(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The serving table that the job with state keeps up to date."""
    path = shared_folder(spark, "serving")
    _aggregated(spark, sf_dir, serving_path=path, publish_every=3)
    return rounded(_ntz(read_serving(spark, path).drop("day"), "window_start", "window_end"))


def _served_rollup_sql(unit: str) -> str:
    return f"""SELECT metric_name, round(sum(delta), 4) AS metric_value,
  date_trunc('{unit}', window_start)::TIMESTAMP AS window_start,
  date_trunc('{unit}', window_start)::TIMESTAMP + INTERVAL 1 {unit} AS window_end
FROM judged WHERE NOT late GROUP BY metric_name, date_trunc('{unit}', window_start)"""


@query(f"{CAPTURE} {_served_rollup_sql('hour')} UNION ALL {_served_rollup_sql('day')}")
def served_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours and days of the serving table, kept up to date with the minutes of touched days."""
    path = shared_folder(spark, "serving")
    captured(spark, sf_dir, serving_path=path, rollups=["1 hour", "1 day"])
    longer = F.col("window_end") > F.col("window_start") + F.expr("INTERVAL 1 MINUTE")
    return rounded(_ntz(read_serving(spark, path).filter(longer).drop("day"), "window_start", "window_end"))


# Seconds from landing to reading that a run of this query may take, waiting for slices included.
VISIBLE_WITHIN = 3600


@query(
    f"""{CAPTURE}
SELECT metric_name, count(*) AS n_windows, count(*) AS n_visible
FROM (SELECT DISTINCT metric_name, window_start FROM judged WHERE NOT late) GROUP BY metric_name"""
)
def served_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that could be read soon enough after their rows had landed, by the times of the files."""
    path = shared_folder(spark, "serving")
    out = captured(
        spark, sf_dir, serving_path=path, settings=RECORDED, landed=F.col("_metadata.file_modification_time")
    )
    deltas = replayed_deltas(spark, out).filter(~F.col("late"))
    lags = measures.served_freshness(deltas, read_committed(spark, path), visible_within_seconds=VISIBLE_WITHIN)
    return lags.groupBy("metric_name").agg(
        F.count(F.lit(1)).alias("n_windows"), F.count_if("visible").alias("n_visible")
    )


@query(
    f"""{CAPTURE}
SELECT metric_name, round(sum(delta), 4) AS metric_value, window_start,
  window_start + INTERVAL 1 MINUTE AS window_end
FROM judged WHERE NOT late AND window_start >= TIMESTAMP '2024-01-05 06:30:00'
  AND window_start + INTERVAL 1 MINUTE <= TIMESTAMP '2024-01-19 18:00:00'
GROUP BY metric_name, window_start"""
)
def stream_to_serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of the serving table that the capture keeps up to date."""
    path = shared_folder(spark, "serving")
    captured(spark, sf_dir, serving_path=path)
    served = range_totals(read_serving(spark, path), "2024-01-05T06:30:00Z", "2024-01-19T18:00:00Z")
    return rounded(_ntz(served, "window_start", "window_end"))


@query(
    f"""{capture_sql(43_200_000)}
SELECT metric_name, delta, event_time, arrival AS ingest_time, batch_id,
  date_trunc('minute', event_time) + INTERVAL 1 MINUTE AS window_end, late
FROM judged"""
)
def late_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rows of the capture would have been late had its two bounds been six hours each."""
    path = captured(spark, sf_dir, settings=RECORDED)
    deltas = replayed_deltas(spark, path, Settings(allowed_lateness_seconds=21_600))
    return _ntz(deltas, "event_time", "ingest_time", "window_end")


@query(
    f"""{CAPTURE}
SELECT metric_name, window_start, window_start + INTERVAL 1 MINUTE AS window_end,
  round(sum(delta) FILTER (WHERE NOT late), 4) AS metric_value,
  count(*) FILTER (WHERE late) AS late_rows,
  round(coalesce(sum(delta) FILTER (WHERE late), 0), 4) AS late_value
FROM judged GROUP BY metric_name, window_start"""
)
def late_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On-time and late totals of the recorded batches, by the capture's own settings."""
    path = captured(spark, sf_dir, settings=RECORDED)
    totals = split_totals(replayed_deltas(spark, path))
    return _ntz(rounded(rounded(totals), "late_value"), "window_start", "window_end")


PURGED = "2024-01-20"


@query(
    f"""{CAPTURE},
streamed AS (
  SELECT metric_name, window_start, window_start + INTERVAL 1 MINUTE AS window_end, sum(delta) AS s
  FROM judged WHERE NOT late GROUP BY ALL),
kept AS (
  SELECT d.* FROM deltas d JOIN events e ON e.event_id = d.id
  WHERE NOT (e.event_type = 'error' AND e.ts::DATE = DATE '{PURGED}')),
totals AS (
  SELECT metric_name, date_trunc('minute', event_time) AS window_start,
    date_trunc('minute', event_time) + INTERVAL 1 MINUTE AS window_end, sum(delta) AS b
  FROM kept GROUP BY ALL)
SELECT metric_name, window_start, window_end,
  round(s, 4) AS streamed_value, round(b, 4) AS recomputed_value,
  CASE WHEN s IS NULL THEN 'missing' WHEN b IS NULL THEN 'extra'
    WHEN abs(s - b) <= 1e-6 THEN 'matched' ELSE 'drift' END AS status,
  round(s - b, 4) AS difference
FROM streamed FULL JOIN totals USING (metric_name, window_start, window_end)"""
)
def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table that the capture serves against a recompute from the store of events.

    The capture left late rows out, and the errors of a day were purged from the store since.
    """
    served, store = shared_folder(spark, "serving"), shared_folder(spark, "recomputed")
    captured(spark, sf_dir, serving_path=served)
    purged = F.to_date("event_time") == F.lit(PURGED).cast("date")
    activities = i.activities(spark, sf_dir).filter(~(purged & (F.col("action") == "error")))
    write_serving(event_totals(i.transactions(spark, sf_dir), activities), store)
    streamed = _ntz(read_serving(spark, served), "window_start", "window_end")
    out = reconcile_by_day(streamed, read_serving(spark, store))
    for column in ("streamed_value", "recomputed_value", "difference"):
        out = rounded(out, column)
    return out
