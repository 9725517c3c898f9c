import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import rows
from eventtally.config import Settings
from eventtally.operators.deltas import activity_deltas, all_deltas, transaction_deltas
from eventtally.operators.events import parse_events
from eventtally.operators.totals import window_totals
from eventtally.plans.ingest import ingest_batch, ingest_function
from eventtally.sinks import batch_log, published, serving
from eventtally.sinks.topics import published_records
from eventtally.sources.serving import read_first_windows, read_serving
from eventtally.sources.topics import as_source, both_topics, file_topic, stored_topic
from eventtally.streaming import late_capture as lc
from eventtally.streaming.totals import QUERY_SETTINGS, open_windows, start_totals

NOON = dt.datetime(2024, 1, 1, 12)
DELTA = "metric_name STRING, delta DOUBLE, event_time TIMESTAMP"
TOTAL = "metric_name STRING, metric_value DOUBLE, window_start TIMESTAMP, window_end TIMESTAMP"


def at(text):
    return dt.datetime.fromisoformat("2024-01-01 " + text)


def feed(spark, path, number, frame):
    frame.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={number}")


def run_totals(spark, folder, batches, settings=Settings()):
    """One run per batch, each going on from the checkpoint."""
    for number, times in enumerate(batches):
        feed(spark, folder + "/in", number, spark.createDataFrame([("m", 1.0, at(t)) for t in times], DELTA))
        deltas = spark.readStream.schema(DELTA).parquet(folder + "/in").select(
            "metric_name", "delta", "event_time"
        )
        start_totals(deltas, folder + "/log", folder + "/cp", settings, True).awaitTermination()
    log = batch_log.read_log(spark, folder + "/log")
    return {r.window_start: r.metric_value for r in batch_log.latest_totals(log).collect()}


# The window 12:00 ends at 12:01; with B = L = 30 s it closes when 12:02 has been seen.
@pytest.mark.parametrize("second, kept", [("12:02:00", 1.0), ("12:01:59.999", 2.0)])
def test_watermark_boundary(spark, folder, second, kept):
    got = run_totals(spark, folder, [["12:00:30"], [second], ["12:00:40"]])
    assert got[NOON] == kept


def test_late_row_in_the_batch_that_advances_time_is_kept(spark, folder):
    assert run_totals(spark, folder, [["12:00:30"], ["12:02:00", "12:00:40"]])[NOON] == 2.0


def test_session_settings_are_given_back(spark, folder):
    before = {name: spark.conf.get(name, None) for name in QUERY_SETTINGS}
    run_totals(spark, folder, [["12:00:30"]])
    assert {name: spark.conf.get(name, None) for name in QUERY_SETTINGS} == before


def test_state_holds_open_windows_only(spark, folder):
    """Read from the checkpoint after restarts: 12:00 has closed, the others can still change."""
    run_totals(spark, folder, [["12:00:30"], ["12:01:30", "12:00:40"], ["12:02:10"], ["12:01:50"]])
    state = open_windows(spark, folder + "/cp")
    assert rows(state, "metric_name", "metric_value", "window_start") == [
        ("m", 1.0, NOON + dt.timedelta(minutes=2)),
        ("m", 2.0, NOON + dt.timedelta(minutes=1)),
    ]
    assert os.path.exists(folder + "/cp/state/0/0/1.changelog")


def test_a_small_batch_is_one_file(spark, folder):
    run_totals(spark, folder, [["12:00:30", "12:01:30", "12:02:30", "12:03:30"]])
    files = [n for n in os.listdir(folder + "/log/batches/batch_id=0") if n.startswith("part-")]
    assert len(files) == 1


def test_state_totals_are_served(spark, folder):
    """Published by the batch and at the end; a total that changes later is replaced."""
    for number, times in enumerate([["12:00:30"], ["12:00:40", "12:01:10"], ["12:01:20"]]):
        feed(spark, folder + "/in", number, spark.createDataFrame([("m", 1.0, at(t)) for t in times], DELTA))
        deltas = spark.readStream.schema(DELTA).parquet(folder + "/in").select("metric_name", "delta", "event_time")
        start_totals(
            deltas, folder + "/log", folder + "/cp", Settings(), True, serving_path=folder + "/serving", publish_every=2
        ).awaitTermination()
    assert served(spark, folder) == [(2.0, NOON), (2.0, NOON + dt.timedelta(minutes=1))]
    log = batch_log.read_log(spark, folder + "/log")
    assert rows(batch_log.latest_totals(log), "metric_value", "window_start") == served(spark, folder)


def capture(spark, path, batches, first=0):
    for number, times in enumerate(batches, start=first):
        frame = spark.createDataFrame([("m", 1.0, at(t)) for t in times], DELTA)
        landed = frame.withColumn("ingested_at", F.lit(NOON).cast("timestamp"))
        lc.capture_batch(landed, number, path)


@pytest.mark.parametrize("second, late", [("12:02:00", 1), ("12:01:59.999", 0)])
def test_ledger_boundary(spark, folder, second, late):
    capture(spark, folder, [["12:00:30"], [second], ["12:00:40"]])
    assert lc.captured_late_rows(spark, folder).count() == late
    totals = {r.window_start: r.metric_value for r in lc.captured_totals(spark, folder).collect()}
    assert totals[NOON] == 2.0 - late


def test_ledger_same_batch_is_kept(spark, folder):
    capture(spark, folder, [["12:00:30"], ["12:02:00", "12:00:40"]])
    assert lc.captured_late_rows(spark, folder).count() == 0


def test_repeated_batch_changes_nothing(spark, folder):
    batches = [["12:00:30"], ["12:05:00"], ["12:00:40", "12:05:10"], ["12:00:50"]]
    capture(spark, folder, batches)
    before = rows(lc.captured_totals(spark, folder)), rows(lc.captured_late_rows(spark, folder))
    assert len(before[1]) == 2
    capture(spark, folder, batches[1:3], first=1)
    assert (rows(lc.captured_totals(spark, folder)), rows(lc.captured_late_rows(spark, folder))) == before


def test_empty_batch_carries_the_ledger_on(spark, folder):
    capture(spark, folder, [["12:05:00"], [], ["12:00:30"]])
    assert lc.seen_before_batch(spark, folder + "/ledger", 2) == 1704110700000
    assert lc.captured_late_rows(spark, folder).count() == 1


def test_missing_ledger_row_stops_the_job(spark, folder):
    capture(spark, folder, [["12:05:00"]])
    with pytest.raises(RuntimeError, match="no ledger row for batch 4"):
        capture(spark, folder, [["12:05:00"]], first=5)


def test_folding_keeps_totals(spark, folder):
    batches = [["12:00:30"], ["12:00:31", "12:01:00"], ["12:00:32"], ["12:01:10"]]
    capture(spark, folder, batches)
    before = rows(lc.captured_totals(spark, folder))
    log = folder + "/partials"
    for upto in (1, 3, 2):
        batch_log.fold_log(spark, log, batch_log.added, upto)
        assert rows(lc.captured_totals(spark, folder)) == before
    assert batch_log.read_log(spark, log).count() == 2
    capture(spark, folder, [["12:01:20"]], first=4)
    assert sum(r.metric_value for r in lc.captured_totals(spark, folder).collect()) == 6.0


def total_rows(spark, path, number, days, value=1.0):
    """A batch with a total in each of some days."""
    at_day = lambda n: dt.datetime(2024, 1, n)
    frame = spark.createDataFrame([("m", value, at_day(n), at_day(n) + dt.timedelta(minutes=1)) for n in days], TOTAL)
    batch_log.append_batch(frame, path, number, 1)


def folders(path, *names):
    return sorted(n for n in os.listdir("/".join([path, *names])) if "=" in n and not n.startswith("."))


def test_a_fold_writes_touched_days_and_deletes_what_is_superseded(spark, folder):
    path = folder + "/log"
    total_rows(spark, path, 0, [1, 2, 3])
    batch_log.fold_log(spark, path, batch_log.added, 0)
    total_rows(spark, path, 1, [2])
    batch_log.fold_log(spark, path, batch_log.added, 1)
    # What the mark before needs is still there.
    assert folders(path, "days/upto=0") == ["day=2024-01-01", "day=2024-01-02", "day=2024-01-03"]
    assert folders(path, "days/upto=1") == ["day=2024-01-02"]
    total_rows(spark, path, 2, [3])
    batch_log.fold_log(spark, path, batch_log.added, 2)
    assert folders(path, "days/upto=0") == ["day=2024-01-01", "day=2024-01-03"]
    assert folders(path, "marks") == ["upto=1", "upto=2"] and folders(path, "batches") == ["batch_id=2"]
    total_rows(spark, path, 3, [1])
    batch_log.fold_log(spark, path, batch_log.added, 3)
    total_rows(spark, path, 4, [1])
    batch_log.fold_log(spark, path, batch_log.added, 4)
    assert folders(path, "days") == ["upto=1", "upto=2", "upto=3", "upto=4"]
    got = rows(batch_log.sum_partials(batch_log.read_log(spark, path)), "metric_value", "window_start")
    assert got == [(2.0, dt.datetime(2024, 1, 2)), (2.0, dt.datetime(2024, 1, 3)), (3.0, dt.datetime(2024, 1, 1))]
    touched = batch_log.read_touched(spark, path, 2)
    assert rows(touched, "metric_value", "batch_id") == [(3.0, 4)]


def test_a_fold_without_a_mark_does_not_count(spark, folder):
    path = folder + "/log"
    total_rows(spark, path, 0, [1, 2])
    batch_log.fold_log(spark, path, batch_log.added, 0)
    total_rows(spark, path, 1, [1])
    batch_log.fold_log(spark, path, batch_log.added, 1)
    os.remove(path + "/marks/upto=1")  # as if the driver had gone before it
    total_rows(spark, path, 2, [2])
    want = [(2.0, dt.datetime(2024, 1, 1)), (2.0, dt.datetime(2024, 1, 2))]
    read = lambda: rows(batch_log.sum_partials(batch_log.read_log(spark, path)), "metric_value", "window_start")
    assert read() == want
    batch_log.fold_log(spark, path, batch_log.added, 2)
    assert read() == want


def used(path):
    return sum(os.path.getsize(os.path.join(d, n)) for d, _, names in os.walk(path) for n in names if n.endswith(".parquet"))


def test_fifty_publishes_stay_flat(spark, folder):
    """A long history in other days is neither read nor written; the log does not grow."""
    path, log, table = folder + "/out", folder + "/out/partials", folder + "/serving"
    total_rows(spark, log, 0, range(1, 21))
    published.publish(spark, path, log, batch_log.added, 0, table)
    old = {d: os.listdir(f"{table}/{d}") for d in folders(table) if d < "day=2024-01-20"}
    sizes = []
    for number in range(1, 51):
        total_rows(spark, log, number, [20, 21])
        published.publish(spark, path, log, batch_log.added, number, table)
        if number > 2:
            sizes.append((used(log), sum(map(len, (folders(log, "days"), folders(log, "batches"), folders(log, "marks"))))))
    assert max(s for s, _ in sizes) <= 1.05 * min(s for s, _ in sizes) and len({n for _, n in sizes}) == 1
    assert {d: os.listdir(f"{table}/{d}") for d in old} == old
    got = {r.window_start.day: r.metric_value for r in read_serving(spark, table).collect()}
    assert got == {**{n: 1.0 for n in range(1, 20)}, 20: 51.0, 21: 50.0}
    assert os.listdir(path + "/published") and folders(path, "published") == ["upto=50"] and not os.path.exists(path + "/publish")
    first = {r.window_start.day: r.metric_value for r in read_first_windows(spark, table).collect()}
    assert first == got


def test_a_publish_that_broke_off_is_finished(spark, folder, monkeypatch):
    """After the log was folded, and while days were being swapped."""
    path, log, table = folder + "/out", folder + "/out/partials", folder + "/serving"
    other = spark.createDataFrame([("other", 5.0, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2))], TOTAL)
    serving.write_serving(other, table)
    total_rows(spark, log, 0, [1])
    publish = lambda number: published.publish(spark, path, log, batch_log.added, number, table)

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(published, "upsert_serving", broken)
        with pytest.raises(OSError):
            publish(0)
    publish(0)
    assert rows(read_serving(spark, table), "metric_value") == [(1.0,), (5.0,)]
    total_rows(spark, log, 1, [1])
    with monkeypatch.context() as patched:
        patched.setattr(serving, "finish_upsert", broken)
        with pytest.raises(OSError):
            publish(1)
    # A day lost on the way comes back from the copy.
    for name in os.listdir(table + "/day=2024-01-01"):
        os.remove(f"{table}/day=2024-01-01/{name}")
    publish(1)
    assert rows(read_serving(spark, table), "metric_value") == [(2.0,), (5.0,)]


def test_latest_total_wins(spark, folder):
    total = "metric_name STRING, metric_value DOUBLE, window_start TIMESTAMP, window_end TIMESTAMP"
    for number, value in enumerate([1.0, 5.0, 3.0]):
        frame = spark.createDataFrame([("m", value, NOON, NOON)], total)
        batch_log.append_batch(frame, folder + "/log", number, 1)
    log = batch_log.read_log(spark, folder + "/log")
    assert rows(batch_log.latest_totals(log), "metric_value") == [(3.0,)]
    batch_log.fold_log(spark, folder + "/log", batch_log.newest, 1)
    assert rows(batch_log.latest_totals(batch_log.read_log(spark, folder + "/log")), "metric_value") == [(3.0,)]


def wire(spark, n=50):
    return spark.createDataFrame(
        [
            (k, f"synthetic-tx-{k}", k / 4, "USD", "SUCCESS", f"2024-01-01T12:{k % 60:02d}:30Z", NOON)
            for k in range(n)
        ],
        "id BIGINT, description STRING, amount DOUBLE, currency STRING, status STRING, timestamp STRING, ingest_time TIMESTAMP",
    )


def wire_activities(spark, n=50):
    return spark.createDataFrame(
        [(k, ["LOGIN", "log out"][k % 2], None, f"2024-01-01T12:{k % 60:02d}:30Z", NOON) for k in range(n)],
        "id BIGINT, activity STRING, description STRING, timestamp STRING, ingest_time TIMESTAMP",
    )


def test_published_record(spark):
    record = published_records(wire(spark, 2), "transaction").collect()[1]
    assert record.key == "1"
    assert json.loads(record.value) == {
        "id": 1,
        "description": "synthetic-tx-1",
        "amount": 0.25,
        "currency": "USD",
        "status": "SUCCESS",
        "timestamp": "2024-01-01T12:01:30Z",
    }
    activity = published_records(wire_activities(spark, 1), "activity").first()
    assert json.loads(activity.value)["description"] is None


def test_ingest_stores_and_publishes(spark, folder):
    on, off = Settings(publish_enabled=True), Settings()
    ingest_batch(wire(spark), 0, "transaction", folder + "/raw", off, folder + "/topic")
    assert not os.path.exists(folder + "/topic")
    for _ in range(2):
        ingest_batch(wire(spark), 0, "transaction", folder + "/raw", on, folder + "/topic")
    ingest_batch(wire(spark, 3), 1, "transaction", folder + "/raw", on, folder + "/topic")
    raw = spark.read.parquet(folder + "/raw")
    assert raw.count() == 53 and stored_topic(spark, folder + "/topic").count() == 53
    assert "timestamp" in raw.columns and dict(raw.dtypes)["timestamp"] == "string"


def test_from_ingest_to_totals(spark, folder):
    """Typed events in; raw store, topics, capture and totals out; all agree."""
    settings = Settings(publish_enabled=True)
    wire(spark).write.parquet(folder + "/tx")
    wire_activities(spark).write.parquet(folder + "/act")
    for kind, name in (("transaction", "tx"), ("activity", "act")):
        schema = spark.read.parquet(f"{folder}/{name}").schema
        query = (
            spark.readStream.schema(schema)
            .parquet(f"{folder}/{name}")
            .writeStream.option("checkpointLocation", f"{folder}/cp-{name}")
            .foreachBatch(ingest_function(kind, f"{folder}/raw-{name}", settings, f"{folder}/topic-{name}"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    # One unreadable record among them.
    spark.createDataFrame([("9", "{bad", NOON)], "key STRING, value STRING, ingest_time TIMESTAMP").write.parquet(
        folder + "/topic-tx/batch_id=9"
    )
    topics = [file_topic(spark, f"{folder}/topic-{n}") for n in ("tx", "act")]
    lc.start_capture(both_topics(*topics), folder + "/out", folder + "/cp", available_now=True).awaitTermination()
    totals = lc.captured_totals(spark, folder + "/out")
    batch = all_deltas(
        transaction_deltas(parse_events(as_source(_raw(spark, folder, "tx"), "transaction"))),
        activity_deltas(parse_events(as_source(_raw(spark, folder, "act"), "activity"))),
    )
    assert rows(totals) == rows(window_totals(batch))
    names = {r.metric_name for r in totals.collect()}
    assert names == {
        "transaction_count",
        "total_transaction_amount",
        "activity_count",
        "activity_count_LOGIN",
        "activity_count_LOG_OUT",
    }
    letters = spark.read.parquet(folder + "/out/dead_letters")
    assert rows(letters, "raw", "source", "reason") == [("{bad", "transaction", "malformed")]
    assert lc.captured_late_rows(spark, folder + "/out").count() == 0


def _raw(spark, folder, name):
    topic = stored_topic(spark, f"{folder}/topic-{name}")
    return topic.select(F.col("value").alias("raw"), "ingest_time")


def test_upsert_rewrites_touched_days_only(spark, folder):
    day = lambda n: dt.datetime(2024, 1, n)
    one = lambda name, value, n: (name, value, day(n), day(n) + dt.timedelta(minutes=1))
    path = folder + "/serving"
    serving.upsert_serving(
        spark, path, spark.createDataFrame([one("a", 1.0, 1), one("b", 1.0, 1), one("a", 1.0, 2)], TOTAL), folder + "/w0"
    )
    untouched = os.listdir(path + "/day=2024-01-02")
    updates = spark.createDataFrame([one("a", 9.0, 1), one("c", 9.0, 3)], TOTAL)
    for number in (1, 2):
        serving.upsert_serving(spark, path, updates, f"{folder}/w{number}")
        got = rows(read_serving(spark, path), "metric_name", "metric_value", "window_start")
        assert got == sorted(
            [("a", 9.0, day(1)), ("b", 1.0, day(1)), ("a", 1.0, day(2)), ("c", 9.0, day(3))], key=str
        )
    assert os.listdir(path + "/day=2024-01-02") == untouched
    serving.finish_upsert(spark, path, folder + "/w2")
    assert read_serving(spark, path).count() == 4


def test_a_new_run_cannot_overwrite_the_batches_of_another(spark, folder):
    feed(spark, folder + "/in", 0, spark.createDataFrame([("m", 1.0, at("12:00:00"))], DELTA))

    def run(checkpoint):
        deltas = spark.readStream.schema(DELTA).parquet(folder + "/in").select("metric_name", "delta", "event_time")
        start_totals(deltas, folder + "/log", folder + checkpoint, Settings(), True).awaitTermination()

    run("/one")
    run("/one")
    with pytest.raises(Exception, match="another run"):
        run("/two")
    assert batch_log.latest_totals(batch_log.read_log(spark, folder + "/log")).count() == 1


def served_capture(spark, folder, available_now, **settings):
    def captured(batch, batch_id, path, settings):
        lc.capture_batch(batch.withColumn("ingested_at", F.lit(NOON).cast("timestamp")), batch_id, path, settings)

    deltas = spark.readStream.schema(DELTA).parquet(folder + "/in").select("metric_name", "delta", "event_time")
    return lc.start_capture(
        deltas, folder + "/out", folder + "/cp", Settings(), available_now, captured, folder + "/serving", **settings
    )


def served(spark, folder):
    return rows(read_serving(spark, folder + "/serving"), "metric_value", "window_start")


def test_totals_are_served_when_the_stream_has_ended(spark, folder):
    """Also of fewer batches than are published together, and of the rest after the last of them."""
    for number in range(3):
        feed(spark, folder + "/in", number, spark.createDataFrame([("m", 1.0, at("12:00:30"))], DELTA))
        served_capture(spark, folder, True, publish_every=2).awaitTermination()
        assert served(spark, folder) == [(1.0 + number, NOON)]


def test_totals_are_served_while_the_stream_waits(spark, folder):
    feed(spark, folder + "/in", 0, spark.createDataFrame([("m", 1.0, at("12:00:30"))], DELTA))
    query = served_capture(spark, folder, False, publish_seconds=0.5)
    try:
        for number in range(2):
            for _ in range(120):
                time.sleep(0.25)
                if os.path.isdir(folder + "/serving") and os.path.exists(f"{folder}/out/published/upto={number}"):
                    break
            assert served(spark, folder) == [(1.0 + number, NOON)]
            if number == 0:
                feed(spark, folder + "/in", 1, spark.createDataFrame([("m", 1.0, at("12:00:30"))], DELTA))
    finally:
        query.stop()


def test_a_stream_without_batches_ends_in_peace(spark, folder):
    os.makedirs(folder + "/in")
    served_capture(spark, folder, True).awaitTermination()
    assert not os.path.isdir(folder + "/serving")


def test_dead_letters_go_to_the_topic_of_their_source(spark):
    from eventtally.sinks.dead_letters import dead_letter_records

    letters = spark.createDataFrame([("{bad", "transaction", "malformed"), ("x", None, "unknown_type")], "raw STRING, source STRING, reason STRING")
    assert rows(dead_letter_records(letters)) == [
        ("malformed", "{bad", "events.transactions.dlq"), ("unknown_type", "x", "events.activities.dlq")
    ]


def test_rollups_follow_touched_days(spark, folder):
    path, log, table = folder + "/out", folder + "/out/partials", folder + "/serving"
    for number, days in enumerate([[1, 2], [2, 3], [2]]):
        total_rows(spark, log, number, days)
        published.publish(spark, path, log, batch_log.added, number, table, rollups=["1 hour", "1 day"])
    longer = read_serving(spark, table).filter("window_end > window_start + INTERVAL 1 MINUTE")
    got = sorted((r.window_start.day, round((r.window_end - r.window_start).total_seconds()), r.metric_value) for r in longer.collect())
    assert got == sorted((day, size, value) for day, value in ((1, 1.0), (2, 3.0), (3, 1.0)) for size in (3600, 86_400))
