"""Reading and keeping the serving table; lookups and the snapshot; checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventtally.config import Settings
from eventtally.operators import lookup as lk
from eventtally.operators import quality
from eventtally.operators import snapshot as snap
from eventtally.operators.totals import rollup_totals
from eventtally.plans.answer import answer, refreshed
from eventtally.queries import inputs as i
from eventtally.queries.registry import query
from eventtally.queries.totals import TOTALS_OUT, rounded
from eventtally.session import shared_folder
from eventtally.sinks.serving import upsert_serving, write_serving
from eventtally.sources.serving import read_first_windows, read_serving

ISO = "'%Y-%m-%dT%H:%M:%SZ'"


def _served(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """The totals, written to a serving table and read back."""
    path = shared_folder(spark, "serving")
    write_serving(i.totals(spark, sf_dir), path)
    return read_serving(spark, path), path


RESPONSE = f"""SELECT metric_name, round(metric_value, 4) AS metric_value,
  strftime(window_start, {ISO}) AS window_start, strftime(window_end, {ISO}) AS window_end
FROM totals WHERE window_start >= TIMESTAMP '2024-01-05 06:30:00'
  AND window_end <= TIMESTAMP '2024-01-19 18:00:00'"""


@query(f"{i.WITH_TOTALS} {RESPONSE} AND metric_name = 'total_transaction_amount'")
def serving_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    served, _ = _served(spark, sf_dir)
    rows = lk.range_totals(
        served, "2024-01-05T06:30:00Z", "2024-01-19T18:00:00Z", "total_transaction_amount"
    )
    return rounded(lk.response(rows))


@query(f"{i.WITH_TOTALS} {RESPONSE}")
def serving_range_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    served, _ = _served(spark, sf_dir)
    rows = lk.range_totals(served, "2024-01-05T06:30:00Z", "2024-01-19T18:00:00Z")
    return rounded(lk.response(rows))


@query(
    f"""WITH {i.ACT}, {i.TX}, {i.DELTAS}, {i.totals_sql("day")} {TOTALS_OUT}
WHERE metric_name = 'activity_count' AND window_start <= TIMESTAMP '2024-01-15 12:34:56'
  AND window_end > TIMESTAMP '2024-01-15 12:34:56' ORDER BY window_start LIMIT 1"""
)
def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "serving")
    write_serving(i.totals(spark, sf_dir, "1 day"), path)
    served = read_serving(spark, path)
    return rounded(lk.point_total(served, "activity_count", "2024-01-15T12:34:56Z", longest="1 day"))


@query(
    f"""{i.WITH_TOTALS}
SELECT a.id, a.event_time, t.window_start, t.window_end, t.metric_name,
  round(t.metric_value, 4) AS metric_value
FROM act a JOIN totals t ON t.metric_name = 'activity_count'
  AND t.window_start = date_trunc('minute', a.event_time)"""
)
def point_in_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = i.activities(spark, sf_dir).select(
        "id", F.lit("activity_count").alias("metric_name"), "event_time"
    )
    return rounded(lk.window_of_event(asked, i.totals(spark, sf_dir), spread_by=["id"]))


# Totals of minutes and days, and imported ones of 90 minutes, 17 minutes past every hour.
MIXED = f"""{i.WITH_TOTALS}, mixed AS (
  SELECT * FROM totals
  UNION ALL SELECT metric_name, sum(metric_value), date_trunc('day', window_start)::TIMESTAMP,
    date_trunc('day', window_start)::TIMESTAMP + INTERVAL 1 DAY
  FROM totals GROUP BY metric_name, date_trunc('day', window_start)
  UNION ALL SELECT 'activity_count', count(*)::DOUBLE, date_trunc('hour', event_time) + INTERVAL 17 MINUTE,
    date_trunc('hour', event_time) + INTERVAL 107 MINUTE
  FROM act GROUP BY date_trunc('hour', event_time))"""


def _mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, written to a serving table and read back."""
    totals = i.totals(spark, sf_dir)
    hour = F.date_trunc("hour", "event_time").cast("timestamp_ntz")
    imported = (
        i.activities(spark, sf_dir)
        .groupBy(hour.alias("hour"))
        .agg(F.count(F.lit(1)).cast("double").alias("metric_value"))
        .select(
            F.lit("activity_count").alias("metric_name"),
            "metric_value",
            (F.col("hour") + F.expr("INTERVAL 17 MINUTES")).alias("window_start"),
            (F.col("hour") + F.expr("INTERVAL 107 MINUTES")).alias("window_end"),
        )
    )
    path = shared_folder(spark, "serving")
    write_serving(totals.unionByName(rollup_totals(totals, "1 day")).unionByName(imported), path)
    return read_serving(spark, path)


def _asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return i.activities(spark, sf_dir).select(
        "id", F.lit("activity_count").alias("metric_name"), "event_time"
    )


@query(
    f"""{MIXED}
SELECT a.id, a.event_time, t.window_start, t.window_end, t.metric_name,
  round(t.metric_value, 4) AS metric_value
FROM act a JOIN mixed t ON t.metric_name = 'activity_count'
  AND t.window_start <= a.event_time AND t.window_end > a.event_time"""
)
def point_in_any_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All windows that hold an event, in a table of windows of several lengths that overlap."""
    found = lk.windows_of_event(_asked(spark, sf_dir), _mixed(spark, sf_dir), spread_by=["id"])
    return rounded(found)


@query(
    f"""{MIXED}
SELECT id, event_time, 'activity_count' AS metric_name, w.window_start, w.window_end,
  round(w.metric_value, 4) AS metric_value
FROM (SELECT a.id, a.event_time, min({{'window_start': t.window_start, 'window_end': t.window_end,
    'metric_value': t.metric_value}}) AS w
  FROM act a JOIN mixed t ON t.metric_name = 'activity_count'
    AND t.window_start <= a.event_time AND t.window_end > a.event_time
  GROUP BY a.id, a.event_time)"""
)
def point_in_first_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The point lookup for a whole table of instants."""
    found = lk.first_window_of_event(_asked(spark, sf_dir), _mixed(spark, sf_dir), spread_by=["id"])
    return rounded(found)


@query(
    f"""{i.WITH_TOTALS}, days AS (
  SELECT metric_name, sum(metric_value) AS metric_value,
    date_trunc('day', window_start)::TIMESTAMP AS window_start,
    date_trunc('day', window_start)::TIMESTAMP + INTERVAL 1 DAY AS window_end
  FROM totals GROUP BY metric_name, date_trunc('day', window_start))
SELECT metric_name,
  round(metric_value + CASE WHEN metric_name LIKE 'activity_count%' THEN 1 ELSE 0 END, 4)
    AS metric_value, window_start, window_end
FROM totals
UNION ALL SELECT metric_name, round(metric_value, 4), window_start, window_end FROM days"""
)
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    served, path = _served(spark, sf_dir)
    totals = i.totals(spark, sf_dir)
    corrected = totals.filter(F.col("metric_name").startswith("activity_count")).withColumn(
        "metric_value", F.col("metric_value") + 1
    )
    updates = corrected.unionByName(rollup_totals(totals, "1 day"))
    upsert_serving(spark, path, updates, shared_folder(spark, "upsert"))
    return rounded(read_serving(spark, path).drop("day"))


@query(
    f"""{i.WITH_TOTALS}, {i.REQ}
SELECT r.request_id, r.metric_name, r.start, r."end", round(t.metric_value, 4) AS metric_value,
  t.window_start, t.window_end
FROM reqs r JOIN totals t ON t.metric_name = r.metric_name
  AND t.window_start >= r.lo AND t.window_end <= r.hi"""
)
def bulk_range_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    served, _ = _served(spark, sf_dir)
    # A total is in very many answers, so it is rounded before.
    return lk.bulk_range_totals(i.requests(spark, sf_dir), rounded(served), spread_by=["request_id"])


def _probed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snap.probe(
        i.requests(spark, sf_dir), i.snapshot(spark, sf_dir), F.expr(i.AS_OF), Settings().cache_ttl_seconds
    )


@query(
    f"""WITH {i.REQ}, {i.SNAPSHOT}
SELECT request_id, metric_name, start, "end", l.value::DOUBLE AS metric_value
FROM reqs JOIN live l USING (metric_name, start, "end")"""
)
def snapshot_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snap.hits(_probed(spark, sf_dir))


@query(
    f"""WITH {i.REQ}, {i.SNAPSHOT}
SELECT r.metric_name, count(*) AS n_requests, count(l.value) AS n_hits,
  round(count(l.value) / count(*), 10) AS ratio
FROM reqs r LEFT JOIN live l USING (metric_name, start, "end") GROUP BY r.metric_name"""
)
def snapshot_hit_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snap.hit_ratio(_probed(spark, sf_dir)).withColumn("ratio", F.round("ratio", 10))


@query(
    f"""WITH {i.REQ}, {i.SNAPSHOT}
SELECT request_id, metric_name, start, "end" FROM reqs r WHERE NOT EXISTS (
  SELECT 1 FROM live l WHERE l.metric_name = r.metric_name AND l.start = r.start
    AND l."end" = r."end")"""
)
def snapshot_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snap.misses(_probed(spark, sf_dir))


@query(
    f"""{i.WITH_TOTALS}, {i.REQ}
SELECT metric_name, start, "end", round(arg_min(metric_value, window_start), 4) AS value,
  TIMESTAMP '2024-02-01 00:02:00' AS cached_at
FROM (SELECT r.metric_name, r.start, r."end", t.metric_value, t.window_start
  FROM (SELECT DISTINCT metric_name, start, "end", lo, hi FROM reqs) r
  JOIN totals t ON t.metric_name = r.metric_name
    AND t.window_start >= r.lo AND t.window_end <= r.hi)
GROUP BY metric_name, start, "end\""""
)
def snapshot_refill(spark: SparkSession, sf_dir: str) -> DataFrame:
    served, path = _served(spark, sf_dir)
    firsts = read_first_windows(spark, path)
    entries = snap.refill(i.requests(spark, sf_dir), served, firsts, F.expr(i.AS_OF))
    return entries.withColumn("value", F.round(F.col("value").cast("double"), 4))


FOUND = """found AS (
  SELECT r.request_id, r.metric_name, r.start, r."end", t.metric_value,
    t.window_start, t.window_end
  FROM reqs r JOIN totals t ON t.metric_name = r.metric_name
    AND t.window_start >= r.lo AND t.window_end <= r.hi
  WHERE NOT EXISTS (SELECT 1 FROM live l WHERE l.metric_name = r.metric_name
    AND l.start = r.start AND l."end" = r."end"))"""


@query(
    f"""{i.WITH_TOTALS}, {i.REQ}, {i.SNAPSHOT}, {FOUND}
SELECT metric_name, start, "end", arg_max(value, cached_at) AS value, max(cached_at) AS cached_at
FROM (SELECT metric_name, start, "end",
    CASE WHEN value = '' THEN NULL ELSE round(value::DOUBLE, 4) END AS value, cached_at
  FROM snap WHERE NOT EXISTS (SELECT 1 FROM found f WHERE f.metric_name = snap.metric_name
    AND f.start = snap.start AND f."end" = snap."end")
  UNION ALL
  SELECT metric_name, start, "end", round(arg_min(metric_value, window_start), 4),
    TIMESTAMP '2024-02-01 00:02:00' FROM found GROUP BY metric_name, start, "end")
GROUP BY metric_name, start, "end\""""
)
def snapshot_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    served, path = _served(spark, sf_dir)
    firsts = read_first_windows(spark, path)
    after = refreshed(
        i.requests(spark, sf_dir), i.snapshot(spark, sf_dir), served, firsts, F.expr(i.AS_OF)
    )
    return after.withColumn("value", F.round(F.expr("try_cast(value AS DOUBLE)"), 4))


@query(
    f"""{i.WITH_TOTALS}, {i.REQ}, {i.SNAPSHOT}, {FOUND}
SELECT request_id, metric_name, start, "end", l.value::DOUBLE AS metric_value,
  start AS window_start, "end" AS window_end, 'hit' AS source
FROM reqs JOIN live l USING (metric_name, start, "end")
UNION ALL
SELECT request_id, metric_name, start, "end", round(metric_value, 4),
  strftime(window_start, {ISO}), strftime(window_end, {ISO}), 'miss' FROM found"""
)
def answered_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    served, _ = _served(spark, sf_dir)
    # A total is in very many answers, so it is rounded before.
    found = answer(i.requests(spark, sf_dir), i.snapshot(spark, sf_dir), rounded(served), F.expr(i.AS_OF))
    stored_value = F.round("metric_value", 4)
    return found.withColumn(
        "metric_value", F.when(F.col("source") == "hit", stored_value).otherwise(F.col("metric_value"))
    )


@query(
    f"""WITH {i.REQ}, {i.SNAPSHOT}
SELECT * FROM snap WHERE NOT EXISTS (
  SELECT 1 FROM reqs r JOIN customer c ON c.c_custkey = r.request_id
  WHERE c.c_mktsegment = 'BUILDING' AND c.c_nationkey = 7 AND r.metric_name = snap.metric_name
    AND r.start = snap.start AND r."end" = snap."end")"""
)
def snapshot_invalidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    dropped = i.table(spark, sf_dir, "customer").filter(
        (F.col("c_mktsegment") == "BUILDING") & (F.col("c_nationkey") == 7)
    )
    keys = i.requests(spark, sf_dir).join(
        dropped.select(F.col("c_custkey").alias("request_id")), "request_id", "left_semi"
    )
    return snap.invalidated(i.snapshot(spark, sf_dir), keys)


# Totals with planted faults, by the minute of the window.

FAULTY = """faulty AS (
  SELECT CASE minute(window_start) WHEN 7 THEN NULL WHEN 17 THEN repeat('x', 256)
      ELSE metric_name END AS metric_name,
    CASE minute(window_start) WHEN 9 THEN NULL WHEN 11 THEN 'nan'::DOUBLE ELSE metric_value END
      AS metric_value,
    window_start,
    CASE WHEN minute(window_start) = 13 THEN window_start ELSE window_end END AS window_end
  FROM totals)"""


def _faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.minute("window_start")
    return i.totals(spark, sf_dir).select(
        F.when(at == 17, F.repeat(F.lit("x"), 256))
        .when(at != 7, F.col("metric_name"))
        .alias("metric_name"),
        F.when(at == 11, F.lit(float("nan")))
        .when(at != 9, F.col("metric_value"))
        .alias("metric_value"),
        "window_start",
        F.when(at == 13, F.col("window_start")).otherwise(F.col("window_end")).alias("window_end"),
    )


@query(
    f"""{i.WITH_TOTALS}, {FAULTY}
SELECT 'metric_name' AS column_name, true AS found, count(metric_name) AS filled_rows FROM faulty
UNION ALL SELECT 'metric_value', true, count(metric_value) FROM faulty
UNION ALL SELECT 'window_start', true, count(window_start) FROM faulty
UNION ALL SELECT 'window_end', false, 0"""
)
def schema_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One column in capitals, which is fine, and one missing.
    renamed = _faulty(spark, sf_dir).withColumnRenamed("metric_name", "METRIC_NAME")
    return quality.schema_report(renamed.drop("window_end"))


@query(
    f"""{i.WITH_TOTALS}, {FAULTY}
SELECT 'metric_name_null' AS rule, count(*) FILTER (WHERE metric_name IS NULL) AS violations
  FROM faulty
UNION ALL SELECT 'metric_name_too_long', count(*) FILTER (WHERE length(metric_name) > 255) FROM faulty
UNION ALL SELECT 'metric_value_null', count(*) FILTER (WHERE metric_value IS NULL) FROM faulty
UNION ALL SELECT 'metric_value_not_finite',
  count(*) FILTER (WHERE isnan(metric_value) OR isinf(metric_value)) FROM faulty
UNION ALL SELECT 'window_start_null', count(*) FILTER (WHERE window_start IS NULL) FROM faulty
UNION ALL SELECT 'window_end_null', count(*) FILTER (WHERE window_end IS NULL) FROM faulty
UNION ALL SELECT 'window_not_positive', count(*) FILTER (WHERE window_end <= window_start) FROM faulty"""
)
def constraint_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.constraint_violations(_faulty(spark, sf_dir))


@query(
    f"""{i.WITH_TOTALS}, {FAULTY}
SELECT minute(window_start)::INTEGER AS at_minute, count(*) AS n_rows,
  CASE minute(window_start) WHEN 7 THEN 'metric_name_null' WHEN 9 THEN 'metric_value_null'
    WHEN 11 THEN 'metric_value_not_finite' WHEN 13 THEN 'window_not_positive'
    ELSE 'metric_name_too_long' END AS rules
FROM faulty WHERE minute(window_start) IN (7, 9, 11, 13, 17) GROUP BY ALL"""
)
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = quality.quarantined(_faulty(spark, sf_dir))
    return held.groupBy(
        F.minute("window_start").alias("at_minute"), F.array_join("rules", ",").alias("rules")
    ).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    f"""{i.WITH_TOTALS}
SELECT metric_name, window_start, window_end, 2::BIGINT AS n_rows
FROM totals WHERE minute(window_start) = 23"""
)
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies = F.when(F.minute("window_start") == 23, 2).otherwise(1)
    doubled = i.totals(spark, sf_dir).withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
    return quality.duplicate_keys(doubled)
