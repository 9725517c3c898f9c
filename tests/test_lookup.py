import datetime as dt
import os
import random

import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from eventtally.functions import skew
from eventtally.operators import lookup as lk
from eventtally.operators import snapshot as snap
from eventtally.plans.answer import answer, refreshed
from eventtally.sinks.serving import first_windows, replace_windows, upsert_serving, write_serving
from eventtally.sources.serving import read_first_windows, read_serving

BASE = dt.datetime(2024, 1, 1)
TOTAL = (
    "metric_name STRING, metric_value DOUBLE, window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ"
)


def iso(at):
    return at.strftime("%Y-%m-%dT%H:%M:%SZ")


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(5)
    totals = []
    for name in ("a", "b"):
        for hour in range(24 * 6):
            at = BASE + dt.timedelta(hours=hour)
            totals.append((name, float(hour), at, at + dt.timedelta(hours=1)))
    # A window longer than a day, as an import may bring.
    totals.append(("a", 99.0, BASE, BASE + dt.timedelta(days=3)))
    requests = []
    for n in range(300):
        # Two thirds ask the same question.
        if n % 3:
            start, end = BASE + dt.timedelta(hours=5), BASE + dt.timedelta(hours=30)
            requests.append((n, "a", iso(start), iso(end)))
        else:
            start = BASE + dt.timedelta(minutes=30 * rng.randrange(-100, 320))
            end = start + dt.timedelta(minutes=30 * rng.randrange(0, 200))
            requests.append((n, rng.choice("abc"), iso(start), iso(end)))
    # A range that ends before it starts, and one far wider than the table.
    requests.append((900, "a", iso(BASE + dt.timedelta(days=2)), iso(BASE)))
    requests.append((901, "b", "1970-01-01T00:00:00Z", "2999-01-01T00:00:00Z"))
    return (
        spark.createDataFrame(totals, TOTAL),
        spark.createDataFrame(requests, "request_id INT, metric_name STRING, start STRING, end STRING"),
        totals,
        requests,
    )


def brute_force(totals, requests):
    out = []
    for rid, name, start, end in requests:
        for metric, value, ws, we in totals:
            if metric == name and iso(ws) >= start and iso(we) <= end:
                out.append((rid, name, start, end, value, ws, we))
    return sorted(out, key=str)


COLUMNS = ["request_id", "metric_name", "start", "end", "metric_value", "window_start", "window_end"]


def test_bulk_ranges_equal_brute_force(spark, data):
    totals, requests, t, r = data
    found = lk.bulk_range_totals(requests, totals, spread_by=["request_id"])
    assert rows(found, *COLUMNS) == brute_force(t, r)


def test_bulk_ranges_on_day_folders(spark, data, folder):
    totals, requests, t, r = data
    write_serving(totals, folder + "/s")
    found = lk.bulk_range_totals(requests, read_serving(spark, folder + "/s"))
    assert rows(found, *COLUMNS) == brute_force(t, r)


def test_bulk_ranges_without_hot_keys(spark, data, monkeypatch):
    totals, requests, t, r = data
    found = lk.bulk_range_totals(requests.filter("request_id >= 900"), totals)
    assert rows(found, *COLUMNS) == brute_force(t, [x for x in r if x[0] >= 900])


def test_bad_bound_fails_the_request(spark, data):
    bad = spark.createDataFrame([("a", "2024-01-01", "2024-01-02T00:00:00Z")], "metric_name STRING, start STRING, end STRING")
    with pytest.raises(PySparkException, match="not an instant"):
        lk.bulk_range_totals(bad, data[0]).collect()


def test_single_range_reads_only_its_days(spark, data, folder):
    totals, _, t, _ = data
    write_serving(totals, folder + "/s")
    served = read_serving(spark, folder + "/s")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    found = lk.range_totals(served, "2024-01-02T00:00:00Z", "2024-01-03T00:00:00Z", "b")
    assert found.count() == 24
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "day#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    pushed = plan.split("PushedFilters: [")[1]
    assert "EqualTo(metric_name,b)" in pushed and "GreaterThanOrEqual(window_start" in pushed
    everything = lk.range_totals(served, "2024-01-02T00:00:00Z", "2024-01-03T00:00:00Z")
    assert everything.count() == 48
    with pytest.raises(ValueError):
        lk.range_totals(served, "yesterday", "2024-01-03T00:00:00Z")


def test_bounds_are_inclusive_and_typed(spark, data):
    stamps = data[0].withColumn("window_start", F.col("window_start").cast("timestamp")).withColumn(
        "window_end", F.col("window_end").cast("timestamp")
    )
    for totals in (data[0], stamps):
        one = lk.range_totals(totals, "2024-01-01T05:00:00Z", "2024-01-01T06:00:00Z", "b")
        assert [r.metric_value for r in one.collect()] == [5.0]


def test_point_lookup(spark, data):
    at = lambda text: rows(lk.point_total(data[0], "b", text), "metric_value")
    assert at("2024-01-01T05:00:00Z") == [(5.0,)]
    assert at("2024-01-01T05:59:59.999Z") == [(5.0,)]
    assert at("2025-01-01T00:00:00Z") == []


def test_response_prints_instants(spark, data):
    one = lk.response(lk.point_total(data[0], "b", "2024-01-01T05:00:00Z")).first()
    assert (one.window_start, one.window_end) == ("2024-01-01T05:00:00Z", "2024-01-01T06:00:00Z")


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("limit", [-1, 1 << 30])
def test_lookup_join_is_a_join(spark, how, limit, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_BYTES", limit)
    left = [(n, 1 if n % 3 else n) for n in range(3000)] + [(-1, None)]
    right = [(k, k * 10) for k in range(0, 3000, 2)] + [(1, 11)]
    a = spark.createDataFrame(left, "id INT, k INT")
    b = spark.createDataFrame(right, "k INT, v INT")
    got = skew.lookup_join(a, b, ["k"], ["id"], how)
    assert rows(got, "id", "k", "v") == rows(a.join(b, "k", how), "id", "k", "v")


def test_hot_keys_are_cut(spark):
    frame = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), "id"
    )
    hot = skew.hot_keys(frame, ["k"])
    assert rows(hot) == [(-1, 171)]
    joined = skew.salted_join(frame, spark.createDataFrame([(-1, "x")], "k BIGINT, v STRING"), ["k"], ["id"])
    assert joined.count() == 3000
    plan = joined._jdf.queryExecution().analyzed().toString()
    assert "_part" in plan


def test_window_of_event(spark, data):
    events = spark.createDataFrame(
        [(1, "b", dt.datetime(2024, 1, 1, 5, 30)), (2, "b", dt.datetime(2025, 1, 1)), (3, "z", BASE)],
        "id INT, metric_name STRING, event_time TIMESTAMP_NTZ",
    )
    inner = lk.window_of_event(events, data[0], "1 hour", ["id"])
    assert rows(inner, "id", "metric_value") == [(1, 5.0)]
    left = lk.window_of_event(events, data[0], "1 hour", ["id"], how="left")
    assert rows(left, "id", "metric_value") == [(1, 5.0), (2, None), (3, None)]


AS_OF = "TIMESTAMP_NTZ '2024-02-01 00:01:00'"


def snapshot(spark, entries):
    return spark.createDataFrame(
        entries, "metric_name STRING, start STRING, end STRING, value STRING, cached_at TIMESTAMP_NTZ"
    )


def test_probe_refill_and_invalidate(spark, data):
    totals, _, _, _ = data
    asked = spark.createDataFrame(
        [(1, "b", iso(BASE), iso(BASE + dt.timedelta(hours=3)))] * 3
        + [(2, "b", iso(BASE), iso(BASE + dt.timedelta(hours=2)))]
        + [(3, "z", iso(BASE), iso(BASE + dt.timedelta(hours=2)))],
        "request_id INT, metric_name STRING, start STRING, end STRING",
    )
    now = dt.datetime(2024, 2, 1, 0, 1)
    key = lambda h: ("b", iso(BASE), iso(BASE + dt.timedelta(hours=h)))
    as_of = F.expr(AS_OF)
    for cached_at, value, live in [
        (now - dt.timedelta(seconds=59, microseconds=999999), "7.5", True),
        (now - dt.timedelta(seconds=60), "7.5", False),
        (now, "", False),
        (now, None, False),
    ]:
        probed = snap.probe(asked, snapshot(spark, [(*key(3), value, cached_at)]), as_of)
        assert snap.hits(probed).count() == (3 if live else 0)
        assert snap.misses(probed).count() == (2 if live else 5)
    old = snapshot(spark, [(*key(3), "7.5", now - dt.timedelta(days=9))])
    assert snap.hits(snap.probe(asked, old, as_of, ttl_seconds=None)).count() == 3

    live = snapshot(spark, [(*key(3), "7.5", now), (*key(9), "1.0", now)])
    out = answer(asked, live, totals, as_of)
    assert rows(out, "request_id", "metric_value", "window_start", "source") == [
        (1, 7.5, iso(BASE), "hit"),
        (1, 7.5, iso(BASE), "hit"),
        (1, 7.5, iso(BASE), "hit"),
        (2, 0.0, iso(BASE), "miss"),
        (2, 1.0, iso(BASE + dt.timedelta(hours=1)), "miss"),
    ]
    by_day = totals.withColumn("day", F.to_date("window_start"))
    after = refreshed(asked, live, by_day, first_windows(totals), as_of)
    assert rows(after, "end", "value") == sorted(
        [(key(3)[2], "7.5"), (key(9)[2], "1.0"), (key(2)[2], "0.0")]
    )
    gone = snap.invalidated(after, snapshot(spark, [(*key(9), "", now)]))
    assert gone.count() == 2
    shown = asked.select(snap.cache_key(F.col("metric_name"), F.col("start"), F.col("end")))
    assert shown.first()[0] == ":".join(key(3))


def test_later_entry_replaces_earlier(spark):
    early, late = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    a = snapshot(spark, [("m", "s", "e", "1.0", late), ("n", "s", "e", "1.0", early)])
    b = snapshot(spark, [("m", "s", "e", "2.0", early), ("n", "s", "e", "2.0", late)])
    assert rows(snap.stored(a, b), "metric_name", "value") == [("m", "1.0"), ("n", "2.0")]


def test_a_left_lookup_keeps_events_without_a_time(spark, data):
    totals = data[0] if isinstance(data, tuple) else data
    events = spark.createDataFrame(
        [("a", BASE + dt.timedelta(minutes=5)), ("a", None), (None, BASE), ("z", BASE)], "metric_name STRING, event_time TIMESTAMP_NTZ"
    )
    served = spark.createDataFrame([("a", 1.0, BASE, BASE + dt.timedelta(hours=1))], TOTAL)
    found = lk.window_of_event(events, served, "1 hour", how="left").collect()
    assert len(found) == 4 and [r["metric_value"] for r in found if r["metric_value"]] == [1.0]


def test_bulk_bounds_keep_their_digits(spark):
    start = BASE + dt.timedelta(microseconds=400)
    served = spark.createDataFrame(
        [("a", 1.0, start, start + dt.timedelta(minutes=1)), ("a", 2.0, BASE + dt.timedelta(milliseconds=1), BASE + dt.timedelta(minutes=2))],
        TOTAL,
    )
    bounds = "2024-01-01T00:00:00.000500Z", "2024-01-01T01:00:00Z"
    alone = lk.range_totals(served, *bounds, "a")
    asked = spark.createDataFrame([("a", *bounds)], "metric_name STRING, start STRING, end STRING")
    assert rows(alone, "metric_value") == rows(lk.bulk_range_totals(asked, served), "metric_value") == [(2.0,)]


def test_lookups_read_the_asked_days_only(spark, folder):
    served = spark.createDataFrame(
        [(m, float(d), BASE + dt.timedelta(days=d), BASE + dt.timedelta(days=d, minutes=1)) for d in range(9) for m in "ab"], TOTAL
    )
    write_serving(served, folder + "/s")
    table = read_serving(spark, folder + "/s")
    plan = lambda f: f._jdf.queryExecution().executedPlan().toString()
    point = lk.point_total(table, "a", "2024-01-04T00:00:30Z", longest="1 day")
    assert rows(point, "metric_value") == [(3.0,)]
    assert "<= 2024-01-04" in plan(point) and ">= 2024-01-03" in plan(point)
    asked = spark.createDataFrame([("a", "2024-01-03T00:00:00Z", "2024-01-05T00:00:00Z")], "metric_name STRING, start STRING, end STRING")
    bulk = lk.bulk_range_totals(asked, table)
    assert len(bulk.collect()) == 2
    partition_filters = [line for line in plan(bulk).splitlines() if "PartitionFilters" in line]
    assert any(">= 2024-01-03" in line and "<= 2024-01-05" in line for line in partition_filters)
    assert "LeftSemi" in plan(bulk)


@pytest.mark.parametrize("broadcast", [True, False])
def test_earliest_totals_against_all_windows(spark, folder, monkeypatch, broadcast):
    """Windows of several lengths, ranges that begin within a day, far outside, and backwards."""
    if not broadcast:
        monkeypatch.setattr(skew, "BROADCAST_BYTES", -1)
    draw = random.Random(4)
    lengths = [1, 60, 1440, 47]
    served = [
        (draw.choice("ab"), float(k), start := BASE + dt.timedelta(minutes=draw.randrange(6 * 1440)), start + dt.timedelta(minutes=lengths[k % 4]))
        for k in range(300)
    ]
    frame = spark.createDataFrame(served, TOTAL)
    write_serving(frame, folder + "/s")
    asked = []
    for _ in range(60):
        low = BASE + dt.timedelta(minutes=draw.randrange(-1440, 7 * 1440))
        asked.append((draw.choice("abz"), iso(low), iso(low + dt.timedelta(minutes=draw.choice([-5, 30, 2000, 99999])))))
    asked += [("a", "0001-01-01T00:00:00Z", "9999-12-31T00:00:00Z")]
    requests = spark.createDataFrame(asked, "metric_name STRING, start STRING, end STRING").distinct()
    found = lk.earliest_totals(requests, read_serving(spark, folder + "/s"), read_first_windows(spark, folder + "/s"))
    want = set()
    for name, start, end in set(asked):
        inside = [(s, e, v) for n, v, s, e in served if n == name and iso(s) >= start and iso(e) <= end]
        if inside:
            want.add((name, start, end, min(inside)[2]))
    assert {(r.metric_name, r.start, r.end, r.metric_value) for r in found.collect()} == want and len(want) > 10


def test_the_index_follows_the_table(spark, folder):
    """Days that are replaced, upserted and emptied."""
    day = lambda n, m=0: BASE.replace(hour=0, minute=0) + dt.timedelta(days=n, minutes=m)
    one = lambda value, n, m=0: ("a", value, day(n, m), day(n, m + 1))
    path = folder + "/s"
    write_serving(spark.createDataFrame([one(1.0, 0), one(2.0, 0, 5), one(3.0, 1)], TOTAL), path)
    upsert_serving(spark, path, spark.createDataFrame([("a", 9.0, day(0, -1), day(0)), one(4.0, 2)], TOTAL), folder + "/w")
    index = lambda: rows(read_first_windows(spark, path), "metric_value", "day")
    dates = [day(n).date() for n in range(-1, 3)]
    assert index() == sorted(zip([9.0, 1.0, 3.0, 4.0], dates), key=str)
    nothing = spark.createDataFrame([], TOTAL)
    replace_windows(spark, path, nothing, F.col("metric_value") == 3.0, (dates[2], dates[2]), folder + "/w2")
    assert index() == sorted(zip([9.0, 1.0, 4.0], [dates[0], dates[1], dates[3]]), key=str)


@pytest.mark.parametrize("broadcast", [True, False])
def test_windows_of_any_length_against_all_pairs(spark, monkeypatch, broadcast):
    """Lengths from a microsecond to years, also powers of two, times before 1970, bounds met exactly."""
    if not broadcast:
        monkeypatch.setattr(skew, "BROADCAST_BYTES", -1)
    draw = random.Random(12)
    moment = lambda: dt.datetime(draw.choice([1969, 1970, 2024]), 1, 1) + dt.timedelta(seconds=draw.randrange(5000))
    lengths = [1, 2, 2**20, 2**26, 60_000_000, 3_600_000_000, 86_400_000_000, 2**50, 0, -5]
    totals = [
        (draw.choice("ab"), float(k), start := moment(), start + dt.timedelta(microseconds=lengths[k % len(lengths)])) for k in range(120)
    ]
    events = [(k, draw.choice("abz"), moment()) for k in range(150)]
    events += [(200 + k, n, s) for k, (n, _, s, _) in enumerate(totals[:40])]
    events += [(300 + k, n, e) for k, (n, _, _, e) in enumerate(totals[:40])]
    events += [(500, None, BASE), (501, "a", None)]
    frame = spark.createDataFrame(events, "id INT, metric_name STRING, event_time TIMESTAMP_NTZ")
    served = spark.createDataFrame(totals, TOTAL)
    want = [(i, v) for i, n, t in events for m, v, s, e in totals if n == m and t is not None and s <= t < e]
    assert rows(lk.windows_of_event(frame, served, ["id"]), "id", "metric_value") == sorted(want, key=str)
    first = {i: min((s, e, v) for m, v, s, e in totals if n == m and s <= t < e)[2] for i, n, t in events if i in dict(want)}
    assert rows(lk.first_window_of_event(frame, served, ["id"]), "id", "metric_value") == sorted(first.items(), key=str)
    assert lk.windows_of_event(frame, served.limit(0), ["id"]).count() == 0


def test_a_hot_metric_and_bucket_is_cut(spark):
    """A third of all events in one window; the plan splits them by id."""
    totals = spark.createDataFrame([("a", 1.0, BASE, BASE + dt.timedelta(minutes=1))], TOTAL)
    events = spark.range(9000).select(
        "id", F.lit("a").alias("metric_name"), F.lit(BASE).cast("timestamp_ntz").alias("event_time")
    )
    asked = events.withColumn("_power", F.lit(26)).withColumn("_bucket", F.lit(0).cast("long"))
    joined = skew.salted_join(asked, totals.withColumns({"_power": F.lit(26), "_bucket": F.lit(0).cast("long")}), ["metric_name", "_power", "_bucket"], ["id"])
    assert joined.count() == 9000 and "_part" in joined._jdf.queryExecution().analyzed().toString()
    assert lk.windows_of_event(events, totals, ["id"]).count() == 9000


@pytest.mark.parametrize("broadcast", [True, False])
def test_bulk_ranges_with_texts_are_worked_out_once_per_total(spark, data, monkeypatch, broadcast):
    """The texts of the bounds are made below the join, and the answers of small totals are not shuffled by key."""
    if not broadcast:
        monkeypatch.setattr(skew, "BROADCAST_BYTES", -1)
    totals, requests, *plain = data
    found = lk.bulk_range_totals(requests, totals, ["request_id"], as_text=True)
    expected = [(*row[:5], iso(row[5]), iso(row[6])) for row in brute_force(*plain)]
    assert rows(found, *COLUMNS) == sorted(expected, key=str)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    join = next(k for k, line in enumerate(plan.splitlines()) if "Join Inner" in line)
    assert "date_format" in plan and not any("date_format" in line for line in plan.splitlines()[:join])
    physical = found._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin [metric_name" in physical and "SortMergeJoin" not in physical) == broadcast


def test_answers_with_one_total_follow_each_other(spark, folder):
    """The answers outnumber all else that is written, so they are laid out for files that keep a run of equal values once."""
    minutes = [(m, float(k), BASE + dt.timedelta(minutes=k), BASE + dt.timedelta(minutes=k + 1)) for k in range(2 * 1440) for m in "ab"]
    cut = [(7 * (n % 9), n % 5) for n in range(400)]
    asked = [(n, "ab"[n % 2], iso(BASE + dt.timedelta(minutes=x)), iso(BASE + dt.timedelta(days=2, minutes=-y))) for n, (x, y) in enumerate(cut)]
    requests = spark.createDataFrame(asked, "request_id INT, metric_name STRING, start STRING, end STRING")
    lk.bulk_range_totals(requests, spark.createDataFrame(minutes, TOTAL), ["request_id"]).write.parquet(folder + "/out")
    files = [os.path.join(folder, "out", f) for f in os.listdir(folder + "/out") if f.endswith(".parquet")]
    starts = [pq.read_table(f, columns=["window_start"])["window_start"].to_numpy() for f in files]
    number = sum(map(len, starts))
    assert number == sum(2 * 1440 - x - y for x, y in cut)
    assert sum(map(os.path.getsize, files)) < 0.6 * number
    assert 20 * sum((s[1:] != s[:-1]).sum() for s in starts) < number


@pytest.mark.parametrize("group", [1, 3, 256])
def test_bulk_ranges_in_groups_of_any_size(spark, data, monkeypatch, group):
    """Equal requests without an id to tell them apart, and requests without a metric, which have no answers."""
    totals, requests, t, r = data
    monkeypatch.setattr(lk, "GROUP", group)
    assert rows(lk.bulk_range_totals(requests, totals), *COLUMNS) == brute_force(t, r)
    alike = spark.createDataFrame([("a", iso(BASE), iso(BASE + dt.timedelta(hours=3)))] * 10 + [(None, iso(BASE), iso(BASE))], "metric_name STRING, start STRING, end STRING")
    assert sorted(x.metric_value for x in lk.bulk_range_totals(alike, totals).collect()) == [0.0] * 10 + [1.0] * 10 + [2.0] * 10
