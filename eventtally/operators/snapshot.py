"""Answers kept for a while: probe, refill, invalidate.

A snapshot holds one value per request key (metric_name, start, end), as text, with
the time it was stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventtally.functions.skew import lookup_join
from eventtally.operators.lookup import earliest_totals

REQUEST_KEY = ["metric_name", "start", "end"]


def cache_key(metric_name: Column, start: Column, end: Column) -> Column:
    """The key a single answer is stored under."""
    return F.concat_ws(":", metric_name, start, end)


def live_entries(snapshot: DataFrame, as_of: Column, ttl_seconds: int | None) -> DataFrame:
    """Entries that hold a value and have not expired; without a TTL none expires."""
    rows = snapshot.filter(F.length("value") > 0)
    if ttl_seconds is None:
        return rows
    expires = F.col("cached_at") + F.expr(f"INTERVAL {int(ttl_seconds)} SECONDS")
    return rows.filter(expires > as_of)


def probe(
    requests: DataFrame, snapshot: DataFrame, as_of: Column, ttl_seconds: int | None = 60
) -> DataFrame:
    """Requests with the live value stored for them, NULL where there is none."""
    live = live_entries(snapshot, as_of, ttl_seconds).select(
        *REQUEST_KEY, F.col("value").alias("cached_value")
    )
    return lookup_join(requests, live, REQUEST_KEY, requests.columns, how="left")


def hits(probed: DataFrame) -> DataFrame:
    """One row per answered request, with the bounds that were asked for."""
    keep = [c for c in probed.columns if c not in ("cached_value", *REQUEST_KEY)]
    return probed.filter(F.col("cached_value").isNotNull()).select(
        *keep,
        *REQUEST_KEY,
        F.col("cached_value").cast("double").alias("metric_value"),
    )


def misses(probed: DataFrame) -> DataFrame:
    """Requests that have to go to the table."""
    return probed.filter(F.col("cached_value").isNull()).drop("cached_value")


def hit_ratio(probed: DataFrame) -> DataFrame:
    """Requests, answered ones and their share, per metric."""
    hit = F.col("cached_value").isNotNull()
    return probed.groupBy("metric_name").agg(
        F.count(F.lit(1)).alias("n_requests"),
        F.count_if(hit).alias("n_hits"),
        F.avg(hit.cast("double")).alias("ratio"),
    )


def refill(missed: DataFrame, totals: DataFrame, firsts: DataFrame, as_of: Column) -> DataFrame:
    """New entries for missed requests: the value of the earliest window in range.

    `totals` and `firsts` are a serving table and its index of first windows. A key that was
    asked for many times is looked up once. Requests without any total get no entry.
    """
    wanted = missed.select(*REQUEST_KEY).distinct()
    found = earliest_totals(wanted, totals, firsts)
    return found.select(
        *REQUEST_KEY, F.col("metric_value").cast("string").alias("value"), as_of.alias("cached_at")
    )


def stored(snapshot: DataFrame, entries: DataFrame) -> DataFrame:
    """The snapshot after new entries: the one stored last per key."""
    rows = snapshot.unionByName(entries)
    latest = F.max_by(F.struct("value", "cached_at"), F.struct("cached_at", "value"))
    return rows.groupBy(*REQUEST_KEY).agg(latest.alias("e")).select(*REQUEST_KEY, "e.*")


def invalidated(snapshot: DataFrame, keys: DataFrame) -> DataFrame:
    """The snapshot without the given keys."""
    return snapshot.join(keys.select(*REQUEST_KEY).distinct(), REQUEST_KEY, "left_anti")
