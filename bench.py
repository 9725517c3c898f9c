"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores. Each batch query runs once to warm
up, then BENCH_RUNS times; the middle time counts. Every result is produced in full and
thrown away. Streaming jobs run once, from an empty checkpoint to the end of the input.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from eventtally.operators import lookup as lk  # noqa: E402
from eventtally.operators.deltas import event_deltas  # noqa: E402
from eventtally.operators.events import parse_events  # noqa: E402
from eventtally.operators.lateness import split_totals  # noqa: E402
from eventtally.operators.reconcile import reconcile_by_day  # noqa: E402
from eventtally.operators.totals import rollup_totals, window_totals  # noqa: E402
from eventtally.plans.replay import replayed_deltas  # noqa: E402
from eventtally.queries import inputs, streams  # noqa: E402
from eventtally.queries.registry import load  # noqa: E402
from eventtally.session import configure, shared_folder  # noqa: E402
from eventtally.sinks.serving import write_serving  # noqa: E402
from eventtally.sources.serving import read_serving  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "tumbling_metrics",
    "tumbling_metrics_from_deltas",
    "order_metrics",
    "dirty_metrics",
    "point_in_window",
    "point_in_any_window",
    "snapshot_refill",
    "user_transaction_summary",
    "user_activity_trend",
    "latency_percentiles",
    "percentiles_heavy_tail",
    "rollup_levels",
    "freshness",
    "ratios",
]
STREAMS = ["stream_metrics", "stream_ledger_totals", "stream_to_serving"]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def run(build) -> float:
    started = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def middle(build, runs: int = RUNS) -> float:
    run(build)
    return statistics.median(run(build) for _ in range(runs))


def main() -> None:
    spark = session()
    queries, _ = load()
    only = set(sys.argv[1:])
    times: dict[str, float] = {}
    rates: dict[str, float] = {}

    def wanted(name: str) -> bool:
        return not only or name in only

    for name in HEADLINE:
        if wanted(name):
            times[name] = middle(lambda name=name: queries[name](spark, SF_DIR))
    for name in STREAMS:
        if wanted(name):
            times[name] = run(lambda name=name: queries[name](spark, SF_DIR))

    # Ingest to totals: raw JSON records on disk, read, parsed and summed.
    events = inputs.table(spark, SF_DIR, "events").count()
    if wanted("raw_json_to_totals"):
        folder = shared_folder(spark, "bench")
        inputs.dirty(spark, SF_DIR).withColumn(
            "ingest_time", F.col("ingest_time").cast("timestamp")
        ).repartition(int(CPUS)).write.parquet(f"{folder}/raw")
        raw = spark.read.parquet(f"{folder}/raw")
        records = raw.count()
        times["raw_json_to_totals"] = middle(
            lambda: window_totals(event_deltas(parse_events(raw)))
        )
        rates["raw_records_per_second"] = records / times["raw_json_to_totals"]

    # Lookups against a serving table on disk.
    if wanted("lookups"):
        serving = shared_folder(spark, "bench-serving")
        write_serving(inputs.totals(spark, SF_DIR), serving)
        served = read_serving(spark, serving)
        requests = inputs.requests(spark, SF_DIR)
        times["bulk_range_lookup"] = middle(
            lambda: lk.bulk_range_totals(requests, served, spread_by=["request_id"])
        )
        asked = requests.count()
        rates["lookups_per_second"] = asked / times["bulk_range_lookup"]
        rates["milliseconds_per_bulk_lookup"] = 1000 * times["bulk_range_lookup"] / asked
        times["rollup_day"] = middle(lambda: rollup_totals(served, "1 day"))

        def single() -> float:
            started = time.perf_counter()
            lk.range_totals(
                served, "2024-01-09T00:00:00Z", "2024-01-10T00:00:00Z", "total_transaction_amount"
            ).collect()
            return time.perf_counter() - started

        times["single_lookup_first"] = single()
        samples = sorted(single() for _ in range(25))
        times["single_lookup_p50"] = samples[12]
        times["single_lookup_p95"] = samples[23]

    # Late rows and reconciliation of a capture that has run; the capture itself is not timed.
    if wanted("replay"):
        served = shared_folder(spark, "bench-served")
        path = streams.captured(spark, SF_DIR, served, streams.RECORDED)
        times["late_split"] = middle(lambda: replayed_deltas(spark, path))
        times["late_metrics"] = middle(lambda: split_totals(replayed_deltas(spark, path)))
        store = shared_folder(spark, "bench-store")
        write_serving(inputs.totals(spark, SF_DIR).withColumns(
            {c: F.col(c).cast("timestamp") for c in ("window_start", "window_end")}
        ), store)
        times["reconcile"] = middle(
            lambda: reconcile_by_day(read_serving(spark, served), read_serving(spark, store))
        )

    if "tumbling_metrics" in times:
        rates["events_per_second"] = events / times["tumbling_metrics"]
    if "stream_metrics" in times:
        rates["streamed_events_per_second"] = events / times["stream_metrics"]
    scale = re.search(r"sf([0-9.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 4),
                "unit": "sec",
                "queries": {k: round(v, 4) for k, v in times.items()},
                "rates": {k: round(v, 3) for k, v in rates.items()},
                "sf": float(scale.group(1)) if scale else SF_DIR,
                "cpus": int(CPUS),
                "runs": RUNS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
