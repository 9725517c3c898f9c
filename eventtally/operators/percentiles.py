"""Nearest-rank percentiles: exact at any size, or approximate in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventtally.functions import skew
from eventtally.session import stored, stored_with_size

# Sketch accuracy; it decides how evenly the work is cut, never the result.
ACCURACY = 10_000
# Parts of one cut, and distinct values that one task may put in order.
PARTS = 64
LAST_CUT = 100_000


def approximate_percentiles(
    rows: DataFrame, by: list[str], column: str, percentiles: Sequence[float]
) -> DataFrame:
    """One pass and a bounded sketch per group."""
    probs = [float(p) for p in percentiles]
    sketch = F.percentile_approx(column, probs, ACCURACY).alias("values")
    pairs = F.arrays_zip(F.array(*map(F.lit, probs)).alias("percentile"), F.col("values").alias("value"))
    return rows.groupBy(*by).agg(sketch).select(*by, F.inline(pairs))


def exact_percentiles(
    rows: DataFrame,
    by: list[str],
    column: str,
    percentiles: Sequence[float],
    last_cut: int = LAST_CUT,
) -> DataFrame:
    """The value of rank ceil(p * n) in each group, for each p.

    A group may be far larger than a task, so no task sorts one. A sketch cuts each
    group into a few slots around the wanted ranks; exact slot counts tell which slot
    holds a rank, whatever the sketch's error. That slot is cut again at quantiles of its
    distinct values until none has more than `last_cut` of these, and only they are put in
    order. The rows are read three times and are not shuffled: each pass combines them
    where they are. A group may have NULL in its name; missing values do not count; NaN
    is above all numbers.
    """
    probs = [float(p) for p in percentiles]
    # A struct is never NULL itself, so joins on it keep groups with NULL in their name.
    group = F.struct(*by) if by else F.struct(F.lit(0).alias("_all"))
    names, by = by, ["_group"]
    values = rows.select(group.alias("_group"), F.col(column).alias("_x")).filter(F.col("_x").isNotNull())

    margin = 2.0 / ACCURACY
    edge_probs = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-margin, margin)})
    sketch = values.groupBy(*by).agg(
        F.percentile_approx("_x", edge_probs, ACCURACY).alias("_edges")
    )
    edges = [F.col("_edges")[k].alias(f"_edge{k}") for k in range(len(edge_probs))]
    sketch, sketch_size = stored_with_size(sketch.select(*by, *edges), "sketch")
    if sketch_size <= skew.BROADCAST_BYTES:
        weighted = values.withColumn("_c", F.lit(1).cast("long"))
    else:
        # The rows have to move: copies of a value go as one row with their number.
        weighted = values.groupBy(*by, "_x").agg(F.count(F.lit(1)).alias("_c"))
    slot = sum(
        (F.when(F.col("_x") >= F.col(f"_edge{k}"), 1).otherwise(0) for k in range(len(edge_probs))),
        F.lit(0),
    )
    slotted = skew.sized_join(weighted, sketch, sketch_size, by, ["_x"]).select(
        *by, "_x", "_c", slot.alias("_slot")
    )

    sizes = stored(slotted.groupBy(*by, "_slot").agg(F.sum("_c").alias("_in")), "slots")
    ranks = F.array(
        *[F.struct(F.lit(p).alias("percentile"), _rank(p, F.col("_n")).alias("_rank")) for p in probs]
    )
    wanted = sizes.groupBy(*by).agg(F.sum("_in").alias("_n")).select(*by, F.inline(ranks))
    keys = [*by, "percentile"]
    in_slot = stored(
        skew.lookup_join(slotted, _holding(sizes, wanted, by, "_slot"), [*by, "_slot"], ["_x"])
        .groupBy(*keys, "_rank", "_x")
        .agg(F.sum("_c").alias("_c")),
        "in-slot",
    )

    in_slot = _cut_down(in_slot, keys, last_cut)
    upto = Window.partitionBy(*keys).orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
    return (
        in_slot.withColumn("_cum", F.sum("_c").over(upto))
        .filter(F.col("_cum") >= F.col("_rank"))
        .groupBy(*keys)
        .agg(F.min("_x").alias("value"))
        .select(*(F.col("_group")[name].alias(name) for name in names), "percentile", "value")
    )


def _cut_down(in_slot: DataFrame, keys: list[str], last_cut: int) -> DataFrame:
    """The part of each slot (distinct `_x`, number `_c`) that holds the rank, small enough to order.

    The values of a slot may lie anywhere, so a cut goes by their own quantiles: a part
    has about 1/PARTS of the distinct values, and a billion of them take three cuts.
    """
    before = None
    while True:
        most = in_slot.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
        if most <= last_cut or (before is not None and most >= before):
            return in_slot
        before = most
        probs = [k / PARTS for k in range(1, PARTS)]
        edges = in_slot.groupBy(*keys).agg(F.percentile_approx("_x", probs, ACCURACY).alias("_edges"))
        part = F.size(F.filter("_edges", lambda edge: F.col("_x") >= edge))
        cut = skew.lookup_join(in_slot, edges, keys, ["_x"]).withColumn("_bin", part).drop("_edges")
        cut = stored(cut, "cut")
        sizes = cut.groupBy(*keys, "_bin").agg(F.sum("_c").alias("_in"))
        wanted = cut.select(*keys, "_rank").distinct()
        holding = _holding(sizes, wanted, keys, "_bin")
        in_slot = stored(
            skew.lookup_join(cut.drop("_rank"), holding, [*keys, "_bin"], ["_x"]).drop("_bin"), "in-slot"
        )


def _rank(p: float, n: Column) -> Column:
    # Rounded first: 0.07 * 100 is a little over 7 in binary.
    return F.greatest(F.lit(1), F.ceil(F.round(F.lit(p) * n, 6))).cast("long")


def _holding(sizes: DataFrame, wanted: DataFrame, by: list[str], slot: str) -> DataFrame:
    """The slot that holds each wanted rank, with the rank counted inside that slot."""
    order = Window.partitionBy(*by).orderBy(slot).rowsBetween(Window.unboundedPreceding, 0)
    ends = sizes.withColumn("_end", F.sum("_in").over(order))
    start = F.col("_end") - F.col("_in")
    return (
        ends.join(wanted, by)
        .filter((F.col("_rank") > start) & (F.col("_rank") <= F.col("_end")))
        .withColumn("_rank", F.col("_rank") - start)
        .drop("_in", "_end")
    )
