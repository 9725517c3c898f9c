import datetime as dt
import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from eventtally.functions import parsing
from eventtally.operators.deltas import event_deltas
from eventtally.operators.events import (
    canonical_activities,
    canonical_transactions,
    parse_events,
    route_events,
)
from eventtally.sinks.dead_letters import dead_letters

LANDED = dt.datetime(2030, 1, 1)


def parse(spark, texts, source):
    raw = spark.createDataFrame([(t, LANDED) for t in texts], "raw STRING, ingest_time TIMESTAMP")
    return parse_events(raw.withColumn("source", F.lit(source)), keep=["raw"])


@pytest.mark.parametrize(
    "text, amount",
    [
        ('{"amount": 12.5}', 12.5),
        ('{"amount": "12.5"}', 12.5),
        ('{"amount": true}', 1.0),
        ('{"amount": "x"}', 0.0),
        ('{"amount": null}', 0.0),
        ('{"amount": {}}', 0.0),
        ("{}", 0.0),
        ("123", 0.0),
        ("null", 0.0),
        ("[]", 0.0),
        ('{"amount": 1} x', 1.0),
        ('{"amount": 1, "amount": 2}', 2.0),
    ],
)
def test_amounts(spark, text, amount):
    row = parse(spark, [text], "transaction").first()
    assert (row.amount, row.reason, row.event_time) == (amount, None, LANDED)


def test_amount_nan_stays_nan(spark):
    assert math.isnan(parse(spark, ['{"amount": "NaN"}'], "transaction").first().amount)


@pytest.mark.parametrize("text", ["", "   ", "{bad", '{"amount": 1', None])
def test_unreadable_records_become_dead_letters(spark, text):
    parsed = parse(spark, [text], "transaction")
    letter = dead_letters(parsed).first()
    assert (letter.raw, letter.reason, letter.ingested_at) == (text, "malformed", LANDED)
    assert event_deltas(parsed).count() == 0


@pytest.mark.parametrize(
    "text, action",
    [
        ('{"action": "LOGIN"}', "LOGIN"),
        ('{"action": null, "activity": "a b"}', "a b"),
        ('{"activity": "a b"}', "a b"),
        ('{"action": "", "activity": "z"}', ""),
        ('{"action": {}}', ""),
        ('{"action": [1]}', ""),
        ('{"action": {"a": 1}, "activity": "z"}', ""),
        ('{"action": 5}', "5"),
        ('{"action": 5.0}', "5.0"),
        ('{"action": true}', "true"),
        ("{}", "UNKNOWN"),
        ("null", "UNKNOWN"),
        ("[]", "UNKNOWN"),
    ],
)
def test_actions(spark, text, action):
    assert parse(spark, [text], "activity").first().action == action


def test_action_names_keep_letters_digits_and_underscores(spark):
    names = spark.createDataFrame([("log-in é😀_x",), ("",), ("a1",)], "a STRING")
    out = names.select(parsing.normalised_action(F.col("a")))
    assert [r[0] for r in out.collect()] == ["LOG_IN____X", "", "A1"]


@pytest.mark.parametrize(
    "text, at",
    [
        ("2025-09-09T12:00:00Z", dt.datetime(2025, 9, 9, 12)),
        ("2025-09-09T12:00:00.123456789Z", dt.datetime(2025, 9, 9, 12, 0, 0, 123000)),
        ("2025-09-09t12:00:00z", dt.datetime(2025, 9, 9, 12)),
        ("2025-09-09T12:00:00+02:00", None),
        ("2025-09-09", None),
        ("2025-09-09 12:00:00Z", None),
        ("2025-09-09T12:00Z", None),
        ("2025-09-09T12:00:00", None),
        ("2025-02-30T00:00:00Z", None),
        ("1757419200", None),
        ("garbage", None),
        ("", None),
        ("  ", None),
        (None, None),
    ],
)
def test_instants(spark, text, at):
    one = spark.createDataFrame([(text,)], "t STRING")
    row = one.select(
        parsing.instant(F.col("t")).alias("at"),
        parsing.event_time(F.col("t"), F.lit(LANDED)).alias("event_time"),
    ).first()
    assert (row.at, row.event_time) == (at, at or LANDED)


def test_numeric_timestamp_falls_back(spark):
    assert parse(spark, ['{"timestamp": 1757419200}'], "activity").first().event_time == LANDED


def test_bad_request_bound_fails(spark):
    one = spark.createDataFrame([("2025-09-09",)], "t STRING")
    with pytest.raises(PySparkException, match="not an instant: 2025-09-09"):
        one.select(parsing.required_instant(F.col("t"))).collect()


def test_iso_text_has_as_many_digits_as_needed(spark):
    times = [dt.datetime(2025, 9, 9, 12, 0, 1, us) for us in (0, 500000, 123456)]
    frame = spark.createDataFrame([(t,) for t in times], "t TIMESTAMP_NTZ")
    assert [r[0] for r in frame.select(parsing.iso_instant(F.col("t"))).collect()] == [
        "2025-09-09T12:00:01Z",
        "2025-09-09T12:00:01.500Z",
        "2025-09-09T12:00:01.123456Z",
    ]


def test_router_tells_kinds_apart(spark):
    texts = [
        '{"type": "transaction", "amount": 42.0}',
        '{"type": "activity", "action": "LOGIN"}',
        '{"type": "other"}',
        "{}",
        "{bad",
    ]
    raw = spark.createDataFrame([(t, LANDED) for t in texts], "raw STRING, ingest_time TIMESTAMP")
    parsed = parse_events(route_events(raw), keep=["raw"])
    assert {r.raw: (r.source, r.reason) for r in parsed.collect()} == {
        texts[0]: ("transaction", None),
        texts[1]: ("activity", None),
        texts[2]: ("other", "unknown_type"),
        texts[3]: (None, "unknown_type"),
        texts[4]: (None, "malformed"),
    }


def test_records_are_parsed_once(spark):
    plan = event_deltas(parse(spark, ['{"amount": 1}'], "transaction"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("parseJson") == 1


def test_canonical_records(spark):
    frame = spark.createDataFrame(
        [(7, 8, 12.345, "USD", "SUCCESS", 1757419200123)],
        "id BIGINT, user_id BIGINT, amount DOUBLE, currency STRING, status STRING, timestamp_ms BIGINT",
    )
    row = canonical_transactions(frame).first()
    assert (row.transactionId, row.userId, str(row.amount)) == ("7", "8", "12.35")
    assert row.timestamp == dt.datetime(2025, 9, 9, 12, 0, 0, 123000)
    acts = spark.createDataFrame(
        [(7, 8, "LOGIN", "{}", 0)],
        "id BIGINT, user_id BIGINT, activity STRING, metadata STRING, timestamp_ms BIGINT",
    )
    assert rows(canonical_activities(acts)) == [("7", "8", "LOGIN", "{}", dt.datetime(1970, 1, 1))]
