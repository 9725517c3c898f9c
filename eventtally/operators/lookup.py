"""Reading totals back: one range, one instant, or a whole table of requests."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventtally.config import SERVING_COLUMNS
from eventtally.functions import skew
from eventtally.functions.parsing import INSTANT_PATTERN, iso_instant, required_instant
from eventtally.functions.skew import lookup_join, salted_join
from eventtally.operators.totals import size_micros, start_of
from eventtally.session import stored, stored_with_size

# So many requests of a metric and day meet a total together.
GROUP = 256


def request_bound(text: str) -> datetime:
    """The instant of a single request bound; anything else is an error."""
    if text is None or not re.match(INSTANT_PATTERN, text):
        raise ValueError(f"not an instant: {text!r}")
    body, _, fraction = text.upper()[:-1].partition(".")
    whole = datetime.strptime(body, "%Y-%m-%dT%H:%M:%S")
    return whole.replace(microsecond=int(fraction[:6].ljust(6, "0")) if fraction else 0)


def bound_literal(at: datetime, kind: str) -> Column:
    """A UTC instant as a constant of a column's own type, so that filters reach the files."""
    if kind == "timestamp_ntz":
        return F.expr(f"TIMESTAMP_NTZ '{at.isoformat(sep=' ')}'")
    return F.expr(f"TIMESTAMP '{at.isoformat(sep=' ')}Z'")


def range_totals(
    totals: DataFrame, start: str, end: str, metric_name: str | None = None
) -> DataFrame:
    """Totals whose window lies in [start, end], of one metric or of all.

    On a table with day folders only the days of the range are read.
    """
    low, high = request_bound(start), request_bound(end)
    types = dict(totals.dtypes)
    inside = (F.col("window_start") >= bound_literal(low, types["window_start"])) & (
        F.col("window_end") <= bound_literal(high, types["window_end"])
    )
    if metric_name is not None:
        inside = inside & (F.col("metric_name") == metric_name)
    if "day" in types:
        inside = inside & F.col("day").between(low.date(), high.date())
    return totals.filter(inside).select(*SERVING_COLUMNS)


def point_total(
    totals: DataFrame, metric_name: str, at: str, longest: str | None = None
) -> DataFrame:
    """The total of the earliest window that contains an instant: one row or none.

    On a table with day folders no later day is read and, if the length of the longest
    window in the table is given, none that is too early to reach the instant.
    """
    instant = request_bound(at)
    types = dict(totals.dtypes)
    inside = (
        (F.col("metric_name") == metric_name)
        & (F.col("window_start") <= bound_literal(instant, types["window_start"]))
        & (F.col("window_end") > bound_literal(instant, types["window_end"]))
    )
    if "day" in types:
        inside = inside & (F.col("day") <= instant.date())
        if longest is not None:
            earliest = instant - timedelta(microseconds=size_micros(longest))
            inside = inside & (F.col("day") >= earliest.date())
    rows = totals.filter(inside)
    return rows.orderBy("window_start", "window_end").limit(1).select(*SERVING_COLUMNS)


def response(totals: DataFrame) -> DataFrame:
    """Totals as a caller sees them, with window bounds as ISO texts."""
    return totals.select(
        "metric_name",
        "metric_value",
        iso_instant(F.col("window_start")).alias("window_start"),
        iso_instant(F.col("window_end")).alias("window_end"),
    )


def bulk_range_totals(
    requests: DataFrame,
    totals: DataFrame,
    spread_by: list[str] | None = None,
    as_text: bool = False,
) -> DataFrame:
    """Every total that lies in the range of each request (metric_name, start, end).

    A range test alone would compare each request with all totals of its metric. Here
    each request is written out once per day of its range and meets the totals of the
    same metric and day, so the join is on equal keys and the two bounds only trim the
    first and the last day. Days outside the table are left out beforehand; of the table
    only the days of the requests are read, and of these only the asked pairs of metric and day
    go on. The requests are shuffled, also a few, which can have very many answers: that spreads the
    work of writing them out. What can be worked out once per total is not left to the answers, which are
    many more: with `as_text` the bounds of the windows become ISO texts before the join. If the
    asked totals are small they go to all tasks, else both sides are shuffled on the keys. Small totals
    meet groups of requests, so that the answers with one total follow each other: files keep
    a run of equal values once, and the answers would else take a multiple of the space.
    """
    kind = dict(totals.dtypes)["window_start"]
    day = F.col("day") if "day" in totals.columns else F.to_date("window_start")
    table_days = totals.agg(F.min(day).alias("low"), F.max(day).alias("high")).first()
    low, high = (F.lit(table_days[k]).cast("date") for k in ("low", "high"))
    columns = requests.columns
    by_day = _by_day(requests, kind, low, high)
    asked = stored(by_day.select("metric_name", "_day").distinct(), "asked")
    span = asked.agg(F.min("_day").alias("low"), F.max("_day").alias("high")).first()
    bounds = ["window_start", "window_end"]
    rows = (
        totals.filter(day.between(*(F.lit(span[k]).cast("date") for k in ("low", "high"))))
        .select(*SERVING_COLUMNS, day.alias("_day"))
        .join(asked, ["metric_name", "_day"], "left_semi")
    )
    name = F.coalesce(F.octet_length("metric_name"), F.lit(0))
    # Eight bytes a value, and texts of up to 27 for the bounds.
    size = rows.agg(F.sum(name + F.lit(40 + 2 * 27 * as_text))).first()[0] or 0
    rows = rows.select("*", *(iso_instant(F.col(b)).alias(f"_{b}") for b in bounds if as_text))
    inside = (F.col("window_start") >= F.col("_from")) & (F.col("window_end") <= F.col("_to"))
    keys, spread_by = ["metric_name", "_day"], spread_by or columns
    if size <= skew.BROADCAST_BYTES:
        met = _grouped(by_day, keys, spread_by).join(F.broadcast(rows), keys)
        each = met.select(*rows.columns, F.explode("_group").alias("_one"))
        of_one = [F.col("_one")[c].alias(c) for c in by_day.columns if c not in keys]
        joined = each.select(*rows.columns, *of_one).filter(inside)
    else:
        joined = salted_join(by_day, rows, keys, spread_by, condition=inside)
    shown = [F.col(f"_{b}").alias(b) if as_text else F.col(b) for b in bounds]
    return joined.select(*columns, "metric_value", *shown)


def _grouped(by_day: DataFrame, keys: list[str], spread_by: list[str]) -> DataFrame:
    """Requests by day dealt evenly to tasks, there in arrays (`_group`) of GROUP rows of the same keys.

    Rows with near bounds share an array. All is done behind one shuffle.
    """
    # As many tasks as the setting says: few bytes of requests are no sign of few answers.
    tasks = int(by_day.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    task = F.pmod(F.xxhash64(*dict.fromkeys([*spread_by, "_day"])), F.lit(tasks)).cast("int")
    together = Window.partitionBy("_task", *keys).orderBy("_from", "_to")
    return (
        by_day.withColumn("_task", task)
        .repartitionById(tasks, "_task")
        .withColumn("_number", F.floor((F.row_number().over(together) - 1) / GROUP))
        .groupBy("_task", *keys, "_number")
        .agg(F.collect_list(F.struct(*(c for c in by_day.columns if c not in keys))).alias("_group"))
        .drop("_task", "_number")
    )


def _by_day(requests: DataFrame, kind: str, low: Column, high: Column) -> DataFrame:
    """A row per request and day of its range (`_day`), from `low` to `high` at most.

    The bounds of a request go along as `_from` and `_to`.
    """
    bounds = requests.withColumn(
        "_from", required_instant(F.col("start")).cast(kind)
    ).withColumn("_to", required_instant(F.col("end")).cast(kind))
    first = F.greatest(F.to_date("_from"), low)
    last = F.least(F.to_date("_to"), high)
    days = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<date>"))
    return bounds.withColumn("_day", F.explode(days))


def earliest_totals(requests: DataFrame, totals: DataFrame, firsts: DataFrame) -> DataFrame:
    """The earliest total in the range of each request (metric_name, start, end).

    `firsts` has the first window of each metric, day and length. Windows are only looked
    at on the first day of a range; of each later day the first one of each length is
    enough, as no later one of its length ends sooner. Both go into one join on metric
    and day.
    """
    kind = dict(totals.dtypes)["window_start"]
    index_days = firsts.agg(F.min("day").alias("low"), F.max("day").alias("high")).first()
    low, high = (F.lit(index_days[k]).cast("date") for k in ("low", "high"))
    by_day = _by_day(requests, kind, low, high)
    asked, asked_size = stored_with_size(
        by_day.withColumn("_whole", F.col("_day") == F.to_date("_from")), "asked"
    )
    # No more days than the table has folders.
    begun = F.broadcast(asked.filter("_whole").select(F.col("_day").alias("day")).distinct())
    rows = (
        totals.join(begun, "day", "left_semi")
        .select(*SERVING_COLUMNS, "day", F.lit(True).alias("_whole"))
        .unionByName(firsts.select(*SERVING_COLUMNS, "day", F.lit(False).alias("_whole")))
        .withColumnRenamed("day", "_day")
    )
    keys = ["metric_name", "_day", "_whole"]
    inside = (F.col("window_start") >= F.col("_from")) & (F.col("window_end") <= F.col("_to"))
    if asked_size <= skew.BROADCAST_BYTES:
        # The windows stay where they are, and so do all answers of a task but the earliest.
        joined = rows.join(F.broadcast(asked), keys).filter(inside)
    else:
        joined = salted_join(asked, rows, keys, requests.columns, condition=inside)
    first = F.min(F.struct("window_start", "window_end", "metric_value")).alias("first")
    return joined.groupBy(*requests.columns).agg(first).select(*requests.columns, "first.*")


def window_of_event(
    events: DataFrame,
    totals: DataFrame,
    size: str = "1 minute",
    spread_by: list[str] | None = None,
    how: str = "inner",
) -> DataFrame:
    """For each event (metric_name, event_time) the total of the window that holds it.

    Tumbling windows make this a join on equal keys: the window start follows from the
    event time. A left join keeps events without a time or a metric.
    """
    kind = dict(events.dtypes)["event_time"]
    keyed = events.withColumn("window_start", start_of(F.col("event_time"), size, kind))
    end = F.col("window_start") + F.expr(f"INTERVAL {size}")
    same_size = totals.filter(F.col("window_end") == end)
    return lookup_join(
        keyed,
        same_size,
        ["metric_name", "window_start"],
        spread_by or events.columns,
        how=how,
    )


def windows_of_event(
    events: DataFrame, totals: DataFrame, spread_by: list[str] | None = None
) -> DataFrame:
    """For each event (metric_name, event_time) the totals of all windows that hold it.

    Windows may have any length and place, and may overlap. Time is cut into buckets, for each
    window into ones of the least power of two that is no shorter than the window: it
    then lies in two buckets at most, and an event meets it in the bucket of its time. So the
    join is on equal keys, and an event is held against windows of its bucket only, which
    are no farther away than their own length. Few lengths occur, so an event is written
    out a few times: once for each power of two.
    """
    start, end, at = (
        F.unix_micros(F.col(c).cast("timestamp")) for c in ("window_start", "window_end", "event_time")
    )
    # The power is counted in whole numbers: of a length less one, the digits in base two.
    power = F.length(F.bin(end - start - 1))
    long = totals.filter(end > start).select(*SERVING_COLUMNS, power.alias("_power"))
    bucket = lambda micros: F.call_function("shiftright", micros, F.col("_power"))  # noqa: E731 - rounds down, also below zero
    placed = long.withColumn("_bucket", F.explode(F.array_distinct(F.array(bucket(start), bucket(end - 1)))))
    table, size = stored_with_size(placed, "placed")
    # At most 63 powers.
    powers = [row[0] for row in table.select("_power").distinct().collect()]
    asked = (
        events.withColumn("_power", F.explode(F.array(*map(F.lit, powers)).cast("array<int>")))
        .withColumn("_bucket", bucket(at))
        .filter(F.col("_bucket").isNotNull())
    )
    kind = dict(events.dtypes)["event_time"]
    inside = (F.col("window_start").cast(kind) <= F.col("event_time")) & (
        F.col("window_end").cast(kind) > F.col("event_time")
    )
    keys = ["metric_name", "_power", "_bucket"]
    joined = skew.sized_join(asked, table, size, keys, spread_by or events.columns, condition=inside)
    return joined.select(*events.columns, "metric_value", "window_start", "window_end")


def first_window_of_event(
    events: DataFrame, totals: DataFrame, spread_by: list[str] | None = None
) -> DataFrame:
    """The earliest of them, as `point_total` gives for one instant; events without one go."""
    found = windows_of_event(events, totals, spread_by)
    first = F.min(F.struct("window_start", "window_end", "metric_value")).alias("first")
    return found.groupBy(*events.columns).agg(first).select(*events.columns, "first.*")
