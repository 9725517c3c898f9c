import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from eventtally.config import Settings
from eventtally.functions import skew
from eventtally.operators.deltas import activity_deltas
from eventtally.operators.lateness import late_split, on_time_totals, split_totals
from eventtally.operators.reconcile import day_digests, reconcile, reconcile_by_day
from eventtally.operators.totals import window_totals
from eventtally.plans.replay import replayed_deltas
from eventtally.sinks.serving import write_serving
from eventtally.sources.serving import read_serving
from eventtally.streaming import late_capture as lc

BASE = dt.datetime(2024, 1, 1)
LOG = "id INT, action STRING, event_time TIMESTAMP_NTZ, batch_id BIGINT"
LEDGER = "batch_id BIGINT, max_event_ms BIGINT"
EPOCH = dt.datetime(1970, 1, 1)


def ms(at):
    return round((at - EPOCH).total_seconds() * 1000)


def ledger_of(log):
    """The running maximum after each batch, from the rows alone."""
    out, top = [], None
    for batch in range(max(b for *_, b in log) + 1):
        seen = [ms(e) for _, _, e, b in log if b == batch]
        top = max([*seen, *([top] if top is not None else [])], default=None)
        out.append((batch, top))
    return out


def brute_force(log, settings):
    out = {}
    for number, _, event, batch in log:
        seen = [ms(e) for _, _, e, b in log if b < batch]
        end = ms(event) // 60_000 * 60_000 + 60_000
        out[number] = bool(seen) and end + settings.watermark_delay_seconds * 1000 <= max(seen)
    return out


def log_of(seed, n=600, batches=40):
    """Time goes on with the batches; a third of the rows comes in one of them, some far behind."""
    rng = random.Random(seed)
    log = []
    for number in range(n):
        batch = 17 if number % 3 == 0 else rng.randrange(batches)
        if batch == 5:  # a batch without rows
            batch = 6
        event = BASE + dt.timedelta(seconds=60 * batch - rng.choice([0, 10, 59, 60, 90, 121, 900]), milliseconds=rng.randrange(1000))
        log.append((number, "x", event, batch))
    return log


@pytest.mark.parametrize("limit", [-1, 1 << 30])
@pytest.mark.parametrize("seed, settings", [(1, Settings()), (2, Settings(allowed_lateness_seconds=300))])
def test_split_equals_brute_force(spark, seed, settings, limit, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_BYTES", limit)
    log = log_of(seed)
    judged = late_split(spark.createDataFrame(log, LOG), spark.createDataFrame(ledger_of(log), LEDGER), settings, ["id"])
    got = {r.id: r.late for r in judged.collect()}
    want = brute_force(log, settings)
    assert judged.count() == len(log) and got == want
    assert 0 < sum(want.values()) < len(log)


@pytest.mark.parametrize("seconds_ms, late", [(60_000, True), (59_999, False)])
def test_boundary(spark, seconds_ms, late):
    end = BASE + dt.timedelta(minutes=1)
    log = [(1, "x", end + dt.timedelta(milliseconds=seconds_ms), 0), (2, "x", BASE + dt.timedelta(seconds=30), 1)]
    ledger = spark.createDataFrame(ledger_of(log), LEDGER)
    got = late_split(spark.createDataFrame(log, LOG), ledger, Settings(), ["id"])
    assert rows(got, "id", "late") == [(1, False), (2, late)]


def test_rows_of_one_batch_do_not_see_each_other(spark):
    log = [(1, "x", BASE + dt.timedelta(hours=5), 0), (2, "x", BASE, 0), (3, "x", BASE, 1)]
    got = late_split(spark.createDataFrame(log, LOG), spark.createDataFrame(ledger_of(log), LEDGER), Settings(), ["id"])
    assert rows(got, "id", "late") == [(1, False), (2, False), (3, True)]


def test_rows_without_a_time_or_a_batch_are_kept(spark):
    log = [(1, "x", BASE, None), (2, "x", None, 3), (3, "x", BASE, 9), (4, "x", BASE, 3), (5, None, None, None)]
    ledger = spark.createDataFrame([(2, ms(BASE) + 10**7), (3, None)], LEDGER)
    got = late_split(spark.createDataFrame(log, LOG), ledger, Settings(), ["id"])
    assert rows(got, "id", "late") == [(1, False), (2, False), (3, False), (4, True), (5, False)]


def test_late_and_on_time_make_up_the_input(spark):
    log = log_of(4)
    judged = late_split(spark.createDataFrame(log, LOG), spark.createDataFrame(ledger_of(log), LEDGER), Settings(), ["id"])
    deltas = activity_deltas(judged, keep=["late"])
    parts = split_totals(deltas).agg(
        F.sum("metric_value"), F.sum("late_rows"), F.sum("late_value")
    ).first()
    assert parts[0] + parts[2] == deltas.count() == 1200
    assert parts[1] == deltas.filter("late").count()


def test_a_replay_gives_what_the_capture_set_apart(spark, folder):
    """By the same settings; a batch that was recorded but has no ledger row is left out."""
    record = "raw STRING, ingest_time TIMESTAMP, source STRING"
    settings = Settings(record_batches=True)
    times = [["12:00:30", "12:00:31"], ["12:05:00"], ["12:00:40", "12:04:30"], [], ["12:02:00"]]
    for number, batch in enumerate(times):
        raw = [(f'{{"id": 1, "action": "a", "timestamp": "2024-01-01T{t}Z"}}', BASE, "activity") for t in batch]
        raw += [("{bad", BASE, "activity")]
        lc.capture_raw_batch(spark.createDataFrame(raw, record), number, folder, settings)
    replayed = replayed_deltas(spark, folder, settings)
    assert rows(replayed.filter("late"), "metric_name", "event_time", "batch_id") == rows(
        lc.captured_late_rows(spark, folder), "metric_name", "event_time", "batch_id"
    )
    assert rows(on_time_totals(replayed)) == rows(lc.captured_totals(spark, folder))
    assert replayed.filter("late").count() == 4
    assert replayed_deltas(spark, folder, Settings(allowed_lateness_seconds=600)).filter("late").count() == 0
    spark.createDataFrame([("x", BASE, "activity")], record).write.parquet(folder + "/records/batch_id=5")
    assert replayed_deltas(spark, folder, settings).count() == 12


def test_reconcile_names_every_difference(spark):
    total = "metric_name STRING, metric_value DOUBLE, window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ"
    at = lambda n, v: (n, v, BASE, BASE + dt.timedelta(minutes=1))
    streamed = spark.createDataFrame(
        [at("same", 1.0), at("parts", 1.0), at("parts", 2.0), at("extra", 1.0), at("drift", 2.0)], total
    )
    batch = spark.createDataFrame(
        [at("same", 1.0 + 1e-9), at("parts", 3.0), at("missing", 1.0), at("drift", 5.0)], total
    )
    got = rows(reconcile(streamed, batch), "metric_name", "status", "difference")
    assert [g[:2] for g in got] == [
        ("drift", "drift"),
        ("extra", "extra"),
        ("missing", "missing"),
        ("parts", "matched"),
        ("same", "matched"),
    ]
    assert got[0][2] == -3.0


TOTAL = "metric_name STRING, metric_value DOUBLE, window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ"


def day_total(name, value, day, minute=0):
    start = BASE + dt.timedelta(days=day, minutes=minute)
    return name, value, start, start + dt.timedelta(minutes=1)


def test_only_days_that_differ_are_compared(spark, folder, monkeypatch):
    draw = random.Random(3)
    ours = [day_total(f"m{k % 5}", draw.random() * 1e6, k % 8, k // 5) for k in range(200)]
    theirs = [(n, v + (draw.random() - 0.5) * 1e-10, s, e) for n, v, s, e in ours]
    theirs = [t for t in theirs if t[2] != BASE + dt.timedelta(days=2, minutes=2)]  # missing from one side
    theirs += [day_total("new", 1.0, 4)]
    theirs = [(n, v + 1, s, e) if s.day == 7 and n == "m1" else (n, v, s, e) for n, v, s, e in theirs]
    theirs += [day_total("lone", 1.0, 30)]
    write_serving(spark.createDataFrame(ours, TOTAL).repartition(3), folder + "/a")
    write_serving(spark.createDataFrame(theirs, TOTAL), folder + "/b")
    a, b = read_serving(spark, folder + "/a"), read_serving(spark, folder + "/b")
    got = reconcile_by_day(a, b)
    whole = reconcile(a, b)
    assert rows(got, "metric_name", "window_start", "status") == rows(whole, "metric_name", "window_start", "status")
    counts = {r["status"]: r["count"] for r in got.groupBy("status").count().collect()}
    assert set(counts) == {"matched", "missing", "extra", "drift"}
    plan = got._jdf.queryExecution().executedPlan().toString()
    same_days = [l for l in plan.splitlines() if "PartitionFilters" in l]
    assert any("2024-01-01" in l and "2024-01-05" not in l for l in same_days)


def test_digests_know_order_from_content(spark):
    ours = [day_total("a", 1.0, 0), day_total("b", 2.0, 0), day_total("a", -0.0, 1)]
    digest = lambda r: rows(day_digests(spark.createDataFrame(r, TOTAL)))
    assert digest(ours) == digest([day_total("a", 0.0, 1), ours[1], ours[0]])
    assert digest(ours) != digest([day_total("a", 2.0, 0), day_total("b", 1.0, 0), ours[2]])
    nothing = spark.createDataFrame([], TOTAL)
    assert reconcile_by_day(nothing, nothing).count() == 0
    one = spark.createDataFrame(ours, TOTAL)
    assert rows(reconcile_by_day(one, nothing).select("status").distinct()) == [("extra",)]


def test_nothing_late_reconciles_fully(spark):
    events = [(n, "x", BASE + dt.timedelta(seconds=n), n // 50) for n in range(500)]
    frame = spark.createDataFrame(events, LOG)
    ledger = spark.createDataFrame(ledger_of(events), LEDGER)
    judged = activity_deltas(late_split(frame, ledger, Settings(), ["id"]), keep=["late"])
    result = reconcile(on_time_totals(judged), window_totals(activity_deltas(frame)))
    assert rows(result.select("status").distinct()) == [("matched",)]
