"""The streaming job from the command line.

    spark-submit --packages org.apache.spark:spark-sql-kafka-0-10_2.13:<version> \\
        --py-files eventtally.zip eventtally/streaming/job.py \\
        --output <folder> --checkpoint <folder> [--serving <folder>]
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from eventtally.config import Settings
from eventtally.session import configure
from eventtally.sources.topics import activities_stream, both_topics, transactions_stream
from eventtally.streaming.late_capture import start_capture

# Argument names, each with the setting it fills.
ARGUMENTS = {
    "kafka.bootstrap": "kafka_bootstrap",
    "kafka.topic.transactions": "transactions_topic",
    "kafka.topic.activities": "activities_topic",
    "kafka.group.id": "group_id",
    "jdbc.url": "jdbc_url",
    "jdbc.user": "jdbc_user",
    "jdbc.password": "jdbc_password",
    "window.allowedLatenessSeconds": "allowed_lateness_seconds",
}


def parse_arguments(argv: Sequence[str] | None = None) -> tuple[Settings, argparse.Namespace]:
    """The settings an argument list asks for, and the two folders of the job."""
    defaults = Settings()
    parser = argparse.ArgumentParser()
    for name, field in ARGUMENTS.items():
        value = getattr(defaults, field)
        kind = int if isinstance(value, int) else str
        parser.add_argument(f"--{name}", dest=field, default=value, type=kind)
    parser.add_argument("--output", required=True)
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--serving")
    parsed = parser.parse_args(argv)
    return Settings(**{field: getattr(parsed, field) for field in ARGUMENTS.values()}), parsed


def main(argv: Sequence[str] | None = None) -> None:
    settings, folders = parse_arguments(argv)
    if settings.jdbc_url is not None:
        raise SystemExit("totals go to folders, not to a database: --jdbc.* cannot be used here")
    spark = configure(SparkSession.builder.appName("event-totals").getOrCreate())
    raw = both_topics(transactions_stream(spark, settings), activities_stream(spark, settings))
    start_capture(
        raw, folders.output, folders.checkpoint, settings, serving_path=folders.serving
    ).awaitTermination()


if __name__ == "__main__":
    main()
