"""What each event adds to which metric."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventtally.config import (
    ACTIVITY_COUNT,
    ACTIVITY_COUNT_PREFIX,
    TRANSACTION_AMOUNT,
    TRANSACTION_COUNT,
)
from eventtally.functions.parsing import UNKNOWN_ACTION, normalised_action
from eventtally.sources.topics import TRANSACTION


def action_metric(action: Column) -> Column:
    return F.concat(F.lit(ACTIVITY_COUNT_PREFIX), normalised_action(action))


def _fan_out(events: DataFrame, pairs: list[tuple[Column, Column]], keep: list[str]) -> DataFrame:
    # The event time travels inside the generated struct: a later test for missing
    # event times then runs on the rows at hand and is not pushed below the parse,
    # where it would read every record a second time.
    rows = [
        F.struct(name.alias("metric_name"), delta.alias("delta"), F.col("event_time"))
        for name, delta in pairs
    ]
    out = events.select(*keep, F.inline(F.array(*rows)))
    return out.filter(F.col("event_time").isNotNull()).select(
        "metric_name", "delta", "event_time", *keep
    )


def transaction_deltas(transactions: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Each transaction counts one and adds its amount, whatever currency or status."""
    return _fan_out(
        transactions,
        [
            (F.lit(TRANSACTION_COUNT), F.lit(1.0)),
            (F.lit(TRANSACTION_AMOUNT), F.coalesce(F.col("amount"), F.lit(0.0))),
        ],
        keep or [],
    )


def activity_deltas(activities: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Each activity counts one in all and one for its action."""
    return _fan_out(
        activities,
        [
            (F.lit(ACTIVITY_COUNT), F.lit(1.0)),
            (action_metric(F.coalesce("action", F.lit(UNKNOWN_ACTION))), F.lit(1.0)),
        ],
        keep or [],
    )


def event_deltas(parsed: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Deltas of a frame that holds both kinds of event, in one pass over it."""
    is_transaction = F.col("source") == TRANSACTION
    return _fan_out(
        parsed,
        [
            (
                F.when(is_transaction, F.lit(TRANSACTION_COUNT)).otherwise(F.lit(ACTIVITY_COUNT)),
                F.lit(1.0),
            ),
            (
                F.when(is_transaction, F.lit(TRANSACTION_AMOUNT)).otherwise(
                    action_metric(F.col("action"))
                ),
                F.when(is_transaction, F.col("amount")).otherwise(F.lit(1.0)),
            ),
        ],
        keep or [],
    )


def all_deltas(*frames: DataFrame) -> DataFrame:
    """The bag union of delta frames."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
