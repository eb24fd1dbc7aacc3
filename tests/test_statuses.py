"""Statuses that last, extreme points, and the payload fields that carry them."""

import json
import random
from datetime import datetime, timedelta, timezone

from conftest import rows
from pyspark.sql import functions as F

from viewloom.operators.statuses import extreme_points, status_durations
from viewloom.sources.payloads import unnest_payloads

SCHEMA = "space string, external_id string, ts timestamp, value double, status_code int, status_symbol string"
DAY = datetime(2024, 1, 1)


def at(**after):
    return DAY + timedelta(**after)


def durations(spark, points, start, end, granularity):
    table = spark.createDataFrame([("s", "x", *p) for p in points], SCHEMA)
    found = status_durations(table, "s:x", start, end, granularity, datetime(2024, 2, 1, tzinfo=timezone.utc))
    names = [f"{part}_{s}" for part in ("count", "duration") for s in ("good", "uncertain", "bad")]
    return {r["timestamp"]: tuple(r[n] for n in names) for r in found.collect()}


def test_a_status_lasts_until_the_next_point(spark):
    points = [
        (at(minutes=10), 1.0, 0, "Good"),
        (at(minutes=40), 2.0, 1, "BadSensor"),
        (at(hours=3, minutes=30), None, 2, " uncertain"),
        (at(hours=3, minutes=45), 3.0, 3, None),
    ]
    got = durations(spark, points, "2024-01-01", "2024-01-01T05:00:00Z", "1h")
    hour, minute = 3_600_000.0, 60_000.0
    assert got == {
        at(hours=0): (1.0, 0.0, 1.0, 30 * minute, 0.0, 20 * minute),
        at(hours=1): (0.0, 0.0, 0.0, 0.0, 0.0, hour),
        at(hours=2): (0.0, 0.0, 0.0, 0.0, 0.0, hour),
        at(hours=3): (1.0, 1.0, 0.0, 15 * minute, 15 * minute, 30 * minute),
        at(hours=4): (0.0, 0.0, 0.0, hour, 0.0, 0.0),
    }
    assert durations(spark, points, "2024-01-01T02:00:00Z", "2024-01-01T03:00:00Z", "1h") == {}


def test_long_gaps_in_short_buckets(spark):
    """A status over more buckets than one block holds, from before 1970 on."""
    points = [(datetime(1969, 12, 31, 23, 59, 59, 500_000), 1.0, 0, "Good"), (datetime(1970, 1, 1, 3), 1.0, 0, "Bad")]
    got = durations(spark, points, "-10000", str(3 * 3_600_000 + 2000), "1s")
    assert len(got) == 3 * 3600 + 3 and sum(v[3] for v in got.values()) == 3 * 3_600_000 + 500 and sum(v[5] for v in got.values()) == 2000


def test_durations_against_a_plain_sweep(spark):
    r = random.Random(3)
    points, moments = [], sorted(r.sample(range(4 * 86_400_000), 400))
    for ms in moments:
        points.append((at(milliseconds=ms), 1.0, 0, r.choice(["Good", "Uncertain", "Bad"])))
    got = durations(spark, points, "2024-01-01", "2024-01-05", "5h")
    want: dict = {}
    width = 5 * 3_600_000
    origin = int(DAY.replace(tzinfo=timezone.utc).timestamp() * 1000)
    for (ms, point), after in zip(zip(moments, points, strict=True), [*moments[1:], 4 * 86_400_000], strict=True):
        kind = ("Good", "Uncertain", "Bad").index(point[3])
        now = ms
        while now < after:
            bucket = (origin + now) // width * width
            cut = min(after, bucket + width - origin) - now
            row = want.setdefault(DAY + timedelta(milliseconds=bucket - origin), [0.0] * 6)
            row[kind] += now == ms
            row[3 + kind] += cut
            now += cut
    assert got == {k: tuple(v) for k, v in want.items()}


def test_extreme_points(spark):
    points = [
        ("s", "x", at(minutes=1), 5.0, 7, "Good"),
        ("s", "x", at(minutes=2), 1.0, 8, "Good"),
        ("s", "x", at(minutes=3), 1.0, None, "Bad"),
        ("s", "x", at(minutes=4), 5.0, 9, "Good"),
        ("s", "x", at(minutes=5), None, 9, "Good"),
        ("s", "y", at(hours=2), 4.0, None, None),
        ("s", "z", at(hours=2), None, 1, None),
    ]
    found = extreme_points(spark.createDataFrame(points, SCHEMA), None, "2024-01-01", "2024-01-02", "1h")
    assert rows(found) == [
        ("s", "x", at(), at(minutes=2), at(minutes=1), 1.0, 8, 5.0, 7),
        ("s", "y", at(hours=2), at(hours=2), at(hours=2), 4.0, None, 4.0, None),
    ]
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()


def test_no_whole_series_in_a_window_of_points(spark):
    """The only window over a whole series is over one row for each hour."""
    table = spark.createDataFrame([], SCHEMA)
    plan = status_durations(table, None, "2024-01-01", "2024-01-02", "1h")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 2 and sum("first_at" in w for w in windows) == 1 and all("stretch" in w for w in windows)


def test_payloads_with_status_fields(spark):
    extreme = {"timestamp": 5, "value": 7.5, "status": {"code": 3, "symbol": "Good"}}
    point = {"timestamp": 1, "countGood": 2.0, "durationBad": 30.0, "maxDatapoint": extreme}
    item = {"instanceId": {"space": "s", "externalId": "x"}, "aggregateDatapoints": {"datapoints": [point]}}
    payloads = spark.createDataFrame([(json.dumps({"items": [item]}),)], "payload string")
    read = lambda name: [(r["value"], r["status_code"], r["status_symbol"]) for r in unnest_payloads(payloads, aggregate=name).collect()]
    assert read("countGood") == [(2.0, None, None)] and read("DURATIONBAD") == [(30.0, None, None)]
    assert read("countBad") == [(None, None, None)]
    assert read("maxDatapoint") == [(7.5, 3, "Good")] and read("minDatapoint") == [(None, None, None)]
    found = unnest_payloads(payloads, aggregate="maxDatapoint").select(F.unix_millis("timestamp")).collect()
    assert found == [(5,)]
