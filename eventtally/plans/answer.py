"""Answering a table of requests through the snapshot and the serving table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventtally.operators import snapshot as snap
from eventtally.operators.lookup import bulk_range_totals


def answer(
    requests: DataFrame,
    snapshot: DataFrame,
    totals: DataFrame,
    as_of: Column,
    ttl_seconds: int | None = 60,
) -> DataFrame:
    """Every request's answer: one stored value, or all totals of its range.

    `source` tells which. A stored answer carries the bounds that were asked for, an
    answer from the table those of each window.
    """
    probed = snap.probe(requests, snapshot, as_of, ttl_seconds)
    hit = snap.hits(probed).select(
        *requests.columns,
        "metric_value",
        F.col("start").alias("window_start"),
        F.col("end").alias("window_end"),
        F.lit("hit").alias("source"),
    )
    miss = bulk_range_totals(snap.misses(probed), totals, as_text=True).select(
        *requests.columns, "metric_value", "window_start", "window_end", F.lit("miss").alias("source")
    )
    return hit.unionByName(miss)


def refreshed(
    requests: DataFrame,
    snapshot: DataFrame,
    totals: DataFrame,
    firsts: DataFrame,
    as_of: Column,
    ttl_seconds: int | None = 60,
) -> DataFrame:
    """The snapshot after these requests were answered; `firsts` is the index of `totals`."""
    missed = snap.misses(snap.probe(requests, snapshot, as_of, ttl_seconds))
    return snap.stored(snapshot, snap.refill(missed, totals, firsts, as_of))
