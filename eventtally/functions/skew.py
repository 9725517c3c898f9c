"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventtally.session import stored, stored_with_size

# A lookup table is sent to every executor only when its measured size is below this.
BROADCAST_BYTES = 64 * 1024 * 1024

# A key is hot when it holds more than one part in this many of all rows. Fewer than
# this many keys can be hot, so the table of hot keys has a fixed bound.
SHARES = 512


def hot_keys(rows: DataFrame, keys: list[str], shares: int = SHARES) -> DataFrame:
    """Keys with more than 1/shares of all rows and the number of parts to cut them into.

    The counts are combined before the shuffle, so a hot key costs no more than others.
    The parts of all hot keys add up to at most 2 * shares.
    """
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    total = counts.agg(F.sum("_rows")).scalar()
    parts = F.ceil(F.lit(shares) * F.col("_rows") / total).cast("int")
    return counts.filter(F.col("_rows") * shares > total).select(
        *keys, parts.alias("_parts")
    )


def salted_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    spread_by: list[str],
    how: str = "inner",
    condition: Column | None = None,
    shares: int = SHARES,
) -> DataFrame:
    """Shuffle both sides on the keys, with the rows of hot keys cut into parts.

    The part of a row follows from a hash of the `spread_by` columns, which should tell
    the rows of one key apart. Lookup rows of hot keys are repeated once per part. Only
    an inner or a left join keeps its meaning under this.
    """
    if how != "inner" and (how != "left" or condition is not None):
        raise ValueError(f"unsupported join: {how} with condition {condition}")
    hot = stored(hot_keys(rows, keys, shares), "hot-keys")
    if hot.isEmpty():
        left, right, on = rows, lookup, keys
    else:
        parts = F.coalesce(F.col("_parts"), F.lit(1))
        cut = F.pmod(F.xxhash64(*spread_by), parts).cast("int")
        left = (
            rows.join(F.broadcast(hot), keys, "left").withColumn("_part", cut).drop("_parts")
        )
        right = (
            lookup.join(F.broadcast(hot), keys, "left")
            .withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
            .drop("_parts")
        )
        on = [*keys, "_part"]
    joined = left.join(right, on, how)
    if condition is not None:
        joined = joined.filter(condition)
    return joined.drop("_part")


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    spread_by: list[str],
    how: str = "inner",
    condition: Column | None = None,
) -> DataFrame:
    """Join many rows with a lookup table without moving the rows if that can be helped.

    The lookup table is worked out once and measured. A small one goes to the rows; with
    a larger one both sides are shuffled and hot keys are cut.
    """
    table, size = stored_with_size(lookup, "lookup")
    return sized_join(rows, table, size, keys, spread_by, how, condition)


def sized_join(
    rows: DataFrame,
    table: DataFrame,
    size: int,
    keys: list[str],
    spread_by: list[str],
    how: str = "inner",
    condition: Column | None = None,
) -> DataFrame:
    """The same with a table that is stored and measured already."""
    if size <= BROADCAST_BYTES and (condition is None or how == "inner"):
        joined = rows.join(F.broadcast(table), keys, how)
        return joined if condition is None else joined.filter(condition)
    return salted_join(rows, table, keys, spread_by, how, condition)
