"""Job settings."""

from __future__ import annotations

from dataclasses import dataclass

# Topic names.
TRANSACTIONS_TOPIC = "events.transactions"
ACTIVITIES_TOPIC = "events.activities"
TRANSACTIONS_DLQ_TOPIC = "events.transactions.dlq"
ACTIVITIES_DLQ_TOPIC = "events.activities.dlq"

# Metric names.
TRANSACTION_COUNT = "transaction_count"
TRANSACTION_AMOUNT = "total_transaction_amount"
ACTIVITY_COUNT = "activity_count"
ACTIVITY_COUNT_PREFIX = "activity_count_"

# The serving table and its columns.
SERVING_TABLE = "aggregated_metrics"
SERVING_KEY = ["metric_name", "window_start", "window_end"]
SERVING_COLUMNS = ["metric_name", "metric_value", "window_start", "window_end"]
MAX_METRIC_NAME = 255


@dataclass(frozen=True)
class Settings:
    """Everything a job can be told."""

    kafka_bootstrap: str = "localhost:9092"
    transactions_topic: str = TRANSACTIONS_TOPIC
    activities_topic: str = ACTIVITIES_TOPIC
    group_id: str = "event-totals"
    starting_offsets: str = "latest"
    jdbc_url: str | None = None
    jdbc_user: str | None = None
    jdbc_password: str | None = None
    window_size: str = "1 minute"
    allowed_lateness_seconds: int = 30
    cache_ttl_seconds: int | None = 60
    visible_within_seconds: int = 120
    publish_enabled: bool = False
    max_offsets_per_trigger: int | None = None
    files_per_batch: int | None = None
    record_batches: bool = False

    @property
    def out_of_orderness_seconds(self) -> int:
        """Bound B of the watermark; one setting serves as B and as lateness L."""
        return self.allowed_lateness_seconds

    @property
    def watermark_delay_seconds(self) -> int:
        """B + L: how far event time must pass a window end before the window closes."""
        return self.out_of_orderness_seconds + self.allowed_lateness_seconds

    def consumer_group(self, topic: str) -> str:
        return f"{self.group_id}-{topic.replace('.', '-')}"
