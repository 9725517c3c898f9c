import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from eventtally.operators import deltas as dl
from eventtally.operators import totals as tt
from eventtally.plans.backfill import backfill, recomputed_totals
from eventtally.sinks.serving import write_serving
from eventtally.sources.serving import read_serving

BASE = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def frames(spark):
    rng = random.Random(3)
    acts, txs = [], []
    for n in range(2000):
        # A third of all events fall into one minute.
        second = 7200 + rng.random() * 59 if n % 3 == 0 else rng.random() * 3 * 86400
        at = BASE + dt.timedelta(seconds=second)
        acts.append((n, rng.choice(["a b", "a-b", "LOGIN", "", "é"]), at))
        if n % 4 == 0:
            txs.append((n, rng.choice([None, 1.25, 2.5, -1.0]), at))
    return (
        spark.createDataFrame(txs, "id BIGINT, amount DOUBLE, event_time TIMESTAMP_NTZ"),
        spark.createDataFrame(acts, "id BIGINT, action STRING, event_time TIMESTAMP_NTZ"),
    )


def expected(frames, seconds):
    sums = {}

    def add(name, at, delta):
        start = BASE + dt.timedelta(seconds=(at - BASE).total_seconds() // seconds * seconds)
        key = (name, start, start + dt.timedelta(seconds=seconds))
        sums[key] = sums.get(key, 0.0) + delta

    for row in frames[0].collect():
        add("transaction_count", row.event_time, 1.0)
        add("total_transaction_amount", row.event_time, row.amount or 0.0)
    for row in frames[1].collect():
        name = "".join(c if c.isascii() and (c.isalnum() or c == "_") else "_" for c in row.action)
        add("activity_count", row.event_time, 1.0)
        add("activity_count_" + name.upper(), row.event_time, 1.0)
    return sums


def as_dict(totals):
    out = {}
    for r in totals.collect():
        key = (r.metric_name, r.window_start, r.window_end)
        assert key not in out
        out[key] = r.metric_value
    return out


@pytest.mark.parametrize("size, seconds", [("1 minute", 60), ("1 hour", 3600), ("1 day", 86400)])
def test_totals_equal_a_plain_count(spark, frames, size, seconds):
    want = expected(frames, seconds)
    union = dl.all_deltas(dl.transaction_deltas(frames[0]), dl.activity_deltas(frames[1]))
    assert as_dict(tt.event_totals(*frames, size)) == want
    assert as_dict(tt.window_totals(union, size)) == want


def test_rollup_equals_larger_windows(spark, frames):
    minutes = tt.event_totals(*frames)
    assert as_dict(tt.rollup_totals(minutes, "1 day")) == expected(frames, 86400)


def test_actions_add_up_to_all_activities(spark, frames):
    sums = as_dict(tt.rollup_totals(tt.activity_totals(frames[1]), "1 day"))
    parts = sum(v for k, v in sums.items() if k[0].startswith("activity_count_"))
    assert parts == sum(v for k, v in sums.items() if k[0] == "activity_count") == 2000


def test_partials_merge(spark, frames):
    txs, acts = frames
    one = tt.event_totals(txs.filter("id % 2 = 0"), acts.filter("id % 2 = 0"))
    two = tt.event_totals(txs.filter("id % 2 = 1"), acts.filter("id % 2 = 1"))
    assert as_dict(tt.merged_totals(one, two)) == expected(frames, 60)


def test_closed_windows_leave_open_ones_out(spark):
    ends = [dt.datetime(2024, 1, 1, 0, m) for m in (1, 2)]
    totals = spark.createDataFrame(
        [("m", 1.0, e - dt.timedelta(minutes=1), e) for e in ends],
        "metric_name STRING, metric_value DOUBLE, window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ",
    )
    newest = F.lit(ends[0] + dt.timedelta(seconds=30)).cast("timestamp_ntz")
    assert rows(tt.closed_totals(totals, newest, 30), "window_end") == [(ends[0],)]


def test_sums_are_combined_before_the_shuffle(spark, frames):
    plan = tt.event_totals(*frames)._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "Exchange" in line:
            below = plan.splitlines()[plan.splitlines().index(line) + 1]
            assert "partial_" in below


def test_recompute_needs_window_bounds(spark, frames):
    with pytest.raises(ValueError, match="not a boundary"):
        recomputed_totals(*frames, "2024-01-01T00:00:30Z", "2024-01-02T00:00:00Z")


def test_backfill_replaces_its_days_only(spark, frames, folder):
    path = folder + "/serving"
    stale = tt.event_totals(*frames).withColumn("metric_value", F.lit(-1.0))
    write_serving(stale, path)
    for _ in range(2):
        backfill(spark, *frames, "2024-01-02T00:00:00Z", "2024-01-03T00:00:00Z", path)
        served = as_dict(read_serving(spark, path))
        want = expected(frames, 60)
        day = dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3)
        assert served == {
            k: (v if day[0] <= k[1] < day[1] else -1.0) for k, v in want.items()
        }


def test_levels_equal_rollups_of_each_size(spark):
    """One pass, also for sizes that do not divide one another; one scan and one sum in the plan."""
    start = dt.datetime(2024, 1, 1)
    rng = random.Random(1)
    values = [(rng.choice(["a", "b", None]), float(k), start + dt.timedelta(minutes=rng.randrange(6000))) for k in range(500)]
    frame = spark.createDataFrame(values, "metric_name STRING, metric_value DOUBLE, window_start TIMESTAMP_NTZ")
    totals = frame.withColumn("window_end", F.col("window_start") + F.expr("INTERVAL 1 MINUTE"))
    sizes = ["15 minutes", "1 hour", "1 day"]
    levels = tt.rollup_levels(totals, sizes)
    each = [tt.rollup_totals(totals, size) for size in sizes]
    assert rows(levels) == rows(each[0].unionByName(each[1]).unionByName(each[2]))
    plan = levels._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == plan.count("Aggregate") == plan.count("LogicalRDD") == 1
