import pytest

from eventtally.config import Settings
from eventtally.session import shared_folder, stored_with_size
from eventtally.streaming.job import parse_arguments


def test_defaults():
    settings, folders = parse_arguments(["--output", "o", "--checkpoint", "c"])
    assert settings == Settings()
    assert (folders.output, folders.checkpoint) == ("o", "c")
    assert settings.watermark_delay_seconds == 60
    assert settings.consumer_group("events.transactions") == "event-totals-events-transactions"


def test_arguments():
    settings, _ = parse_arguments(
        "--output o --checkpoint c --kafka.bootstrap b:1 --kafka.topic.transactions t "
        "--window.allowedLatenessSeconds 5 --jdbc.url u".split()
    )
    assert (settings.kafka_bootstrap, settings.transactions_topic) == ("b:1", "t")
    assert (settings.allowed_lateness_seconds, settings.jdbc_url) == (5, "u")


def test_a_checkpoint_folder_is_required():
    with pytest.raises(SystemExit):
        parse_arguments(["--output", "o"])


def test_shared_folder_is_the_one_the_session_names(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first.startswith(base) and first != second


def test_stored_rows_are_measured(spark):
    frame = spark.createDataFrame([("abc", 1), (None, None)], "t STRING, n INT")
    back, size = stored_with_size(frame, "x")
    assert size == 2 * 16 + 3
    assert sorted(back.collect(), key=str) == sorted(frame.collect(), key=str)
    for empty in (frame.filter("false"), frame.filter("n > 5"), frame.limit(0)):
        back, size = stored_with_size(empty, "x")
        assert (back.count(), size) == (0, 0)
