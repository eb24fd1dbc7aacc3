"""Rollups, ranges, limits and latest points, against a plain Python computation on small series."""

import math
import random
from datetime import datetime, timedelta, timezone

import pytest
from conftest import rows
from pyspark.sql import functions as F

from viewloom.operators import rollups
from viewloom.operators.datapoints import (
    datapoints,
    datapoints_detailed,
    datapoints_of,
    latest_datapoints,
    latest_of_space,
    limit_per_series,
    series_aggregate,
)
from viewloom.operators.joins import join_on_instance, join_on_property, join_on_reference, with_series
from viewloom.plans.sql_surface import create_series_functions

START = datetime(2024, 1, 1)
NOW = datetime(2024, 1, 11, tzinfo=timezone.utc)
RANGE = ("2024-01-01T00:00:00Z", "2024-01-11T00:00:00Z")


def make_points():
    """A long series with most of all points, a sparse one, one with a point on bucket starts, and a single point."""
    draw = random.Random(7)
    points = []
    seconds = sorted(draw.sample(range(10 * 86400), 1500))
    points += [("s", "hot", START + timedelta(seconds=t), round(draw.uniform(-50, 50), 2)) for t in seconds]
    points += [("s", "sparse:x", START + timedelta(hours=h, minutes=7), float(h)) for h in (3, 30, 31, 150)]
    points += [("o", "grid", START + timedelta(hours=h), float(h % 7)) for h in range(6, 200, 6)]
    points += [("o", "one", START + timedelta(days=2, hours=5), 42.0)]
    points += [("o", "early", START - timedelta(days=1), 1.0), ("o", "early", START + timedelta(days=10), 2.0)]
    return points


POINTS = make_points()
INSIDE = [p for p in POINTS if START <= p[2] < START + timedelta(days=10)]
SCHEMA = "space string, external_id string, ts timestamp_ntz, value double"


@pytest.fixture(scope="module", params=["timestamp_ntz", "timestamp"])
def table(spark, request):
    df = spark.createDataFrame(POINTS, SCHEMA)
    coded = df.withColumns({"status_code": F.lit(7), "ts": F.col("ts").cast(request.param)})
    return coded.cache()


def by_series(rows=INSIDE):
    series = {}
    for space, external_id, ts, value in rows:
        series.setdefault((space, external_id), []).append((ts, value))
    return {key: sorted(values) for key, values in series.items()}


def bucket(ts, seconds):
    at = int((ts - datetime(1970, 1, 1)).total_seconds())
    return datetime(1970, 1, 1) + timedelta(seconds=at - at % seconds)


def line_parts(points):
    for (t0, a), (t1, b) in zip(points, points[1:]):
        yield a, b, (t1 - t0).total_seconds()


def continuous_variance(points):
    if len(points) < 2:
        return None
    total = sum(dt for _, _, dt in line_parts(points))
    mean = sum((a + b) / 2 * dt for a, b, dt in line_parts(points)) / total
    return max(sum((a * a + a * b + b * b) / 3 * dt for a, b, dt in line_parts(points)) / total - mean * mean, 0.0)


def variance(values):
    mean = sum(values) / len(values)
    return sum((v - mean) ** 2 for v in values) / len(values)


BY_BUCKET = {
    "average": lambda p: sum(v for _, v in p) / len(p),
    "max": lambda p: max(v for _, v in p),
    "min": lambda p: min(v for _, v in p),
    "count": lambda p: float(len(p)),
    "sum": lambda p: sum(v for _, v in p),
    "discretevariance": lambda p: variance([v for _, v in p]),
    "totalvariation": lambda p: sum(abs(b - a) for a, b, _ in line_parts(p)),
    "continuousvariance": continuous_variance,
}


def expected_rollup(name, seconds):
    result = {}
    for key, points in by_series(INSIDE if name in BY_BUCKET else POINTS).items():
        if name in BY_BUCKET:
            groups = {}
            for point in points:
                groups.setdefault(bucket(point[0], seconds), []).append(point)
            result.update({(*key, b): BY_BUCKET[name](g) for b, g in groups.items()})
            continue
        at = bucket(START - timedelta(microseconds=1), seconds) + timedelta(seconds=seconds)
        while at < START + timedelta(days=10):
            before = [p for p in points if p[0] <= at]
            after = [p for p in points if p[0] >= at]
            value = before[-1][1] if before else None
            if name == "interpolation" and before and before[-1][0] != at:
                (t0, a), (t1, b) = before[-1], after[0] if after else (None, None)
                value = a + (b - a) * ((at - t0) / (t1 - t0)) if after else None
            if value is not None:
                result[(*key, at)] = value
            at += timedelta(seconds=seconds)
    return result


def agree(got, expected):
    assert set(got) == set(expected)
    for key, value in expected.items():
        if value is None:
            assert got[key] is None, key
        else:
            assert math.isclose(got[key], value, rel_tol=1e-9, abs_tol=1e-6), key


WIDTHS = {"30m": 1800, "90m": 5400, "1d": 86400, "3d": 259200}


@pytest.mark.parametrize("name", rollups.AGGREGATES)
@pytest.mark.parametrize("granularity", ["30m", "3d"])
def test_rollups(table, name, granularity):
    df = datapoints_detailed(table, None, *RANGE, aggregates=name, granularity=granularity)
    got = {(r.space, r.external_id, r.timestamp): r.value for r in df.collect()}
    agree(got, expected_rollup(name, WIDTHS[granularity]))


@pytest.mark.parametrize("name", ["interpolation", "stepinterpolation", "totalvariation", "continuousvariance"])
def test_small_blocks_and_stretches_change_nothing(table, name, monkeypatch):
    monkeypatch.setattr(rollups, "GRID_BUCKETS", 3)
    monkeypatch.setattr(rollups, "STRETCH", 600 * rollups.MICROS)
    df = datapoints_detailed(table, None, *RANGE, aggregates=name, granularity="90m")
    got = {(r.space, r.external_id, r.timestamp): r.value for r in df.collect()}
    agree(got, expected_rollup(name, 5400))


def test_an_unaligned_range(table):
    df = datapoints(table, "o:grid", "2024-01-01T13:30:00Z", "2024-01-01T23:00:00Z", "stepInterpolation", "4h")
    assert rows(df) == [(datetime(2024, 1, 1, 16), 5.0), (datetime(2024, 1, 1, 20), 4.0)]
    assert datapoints(table, "o:grid", "2024-01-01T12:30:00Z", "2024-01-01T13:00:00Z", "interpolation", "1d").count() == 0


def test_ranges_are_half_open_and_unknown_ids_are_ignored(table):
    assert datapoints(table, "o:early", *RANGE).count() == 0
    assert datapoints(table, "o:early", "2023-12-31T00:00:00Z", "2024-01-11 00:00:00").count() == 1
    assert datapoints_of(table, "o", "early", "0", "now").count() == 2
    assert datapoints(table, "o:one", now=datetime(2024, 1, 17, 5)).count() == 1
    assert datapoints(table, "o:one", now=datetime(2024, 1, 17, 5, 0, 1)).count() == 0
    detailed = datapoints_detailed(table, "o:one, nowhere:x, s:sparse:x", *RANGE)
    assert detailed.columns == ["timestamp", "value", "value_string", "status_code", "status_symbol", "external_id",
                                "space"]
    assert sorted({(r.space, r.external_id, r.status_code) for r in detailed.collect()}) == [
        ("o", "one", 7), ("s", "sparse:x", 7)]
    rolled = datapoints_detailed(table, "o:one", *RANGE, aggregates="max", granularity="1d").first()
    assert (rolled.value, rolled.status_code, rolled.status_symbol) == (42.0, None, None)


def test_many_ids_join_instead_of_filtering(table):
    ids = [("o", f"none{i}") for i in range(1500)] + [("o", "one"), ("s", "sparse:x")]
    assert datapoints_detailed(table, ids, *RANGE).count() == 5


def test_argument_checks(table):
    with pytest.raises(ValueError, match="unknown aggregate"):
        datapoints(table, "o:one", aggregates="median", granularity="1d")
    for kwargs in (dict(aggregates="max"), dict(granularity="1d")):
        with pytest.raises(ValueError, match="go together"):
            datapoints(table, "o:one", **kwargs)
    with pytest.raises(ValueError, match="not a time"):
        datapoints(table, "o:one", start="lately")
    for i, name in enumerate(("start", "end", "aggregate", "granularity")):
        hints = ["0", "now", "avg", "1d"]
        hints[i] = None
        with pytest.raises(ValueError, match=f"required: {name}"):
            series_aggregate(table, "o:one", *hints)
    with pytest.raises(ValueError, match="unknown aggregate"):
        series_aggregate(table, "o:one", "0", "now", "interpolation", "1d")


def test_limits(table):
    raw = datapoints_detailed(table, None, *RANGE)
    for cap in (1, 3, 700):
        kept = rows(limit_per_series(raw, cap).select("space", "external_id", "timestamp"))
        expected = [(*k, ts) for k, points in by_series().items() for ts, _ in points[:cap]]
        assert kept == sorted(expected, key=repr)
    shared = datapoints_detailed(table, "s:hot,o:grid", *RANGE, total_limit=5)
    assert rows(shared.groupBy("external_id").count()) == [("grid", 2), ("hot", 2)]
    least = series_aggregate(table, "s:hot,o:grid,o:one", *RANGE, "max", "1d", total_limit=2)
    assert rows(least.groupBy("external_id").count()) == [("grid", 1), ("hot", 1), ("one", 1)]


def test_latest(table):
    last = {k: points[-1] for k, points in by_series().items()}
    got = latest_datapoints(table, None, before=RANGE[1], include_status=True)
    expected = [(f"{s}:{e}", ts, v, 7) for (s, e), (ts, v) in last.items()]
    expected.append(("o:early", START - timedelta(days=1), 1.0, 7))
    assert rows(got) == sorted(expected, key=repr)
    before = latest_datapoints(table, "o:grid,o:one,o:none", before="2024-01-01T12:00:00Z")
    assert rows(before) == [("o:grid", datetime(2024, 1, 1, 6), 6.0, None)]
    one_space = latest_of_space(table, "o", "grid, one", now=NOW)
    assert [r[0] for r in rows(one_space)] == ["grid", "one"]
    assert latest_datapoints(table, "o:early", before="2023-01-01T00:00:00Z").count() == 0


def test_text_points_keep_their_text(spark):
    df = spark.createDataFrame([("s", "t", START, None, "on")], SCHEMA + ", value_string string")
    assert rows(datapoints_detailed(df, "s:t", *RANGE).select("value", "value_string")) == [(None, "on")]
    assert datapoints_detailed(df, "s:t", *RANGE, aggregates="count", granularity="1d").count() == 0


def test_views_with_their_series(spark, table):
    view = spark.createDataFrame([("v1", "o", "one", "s:sparse:x"), ("v2", None, None, None), ("v3", "o", "none", "x")],
                                 "id string, sp string, ext string, ref string")
    series = datapoints_detailed(table, None, *RANGE)
    values = {"timestamp": "timestamp", "value": "value"}
    assert rows(with_series(view, series, values, "sp", "ext").select("id", "value")) == [("v1", 42.0)]
    by_id = with_series(view, series, values, instance_id="ref")
    assert [r.value for r in by_id.orderBy("value").collect()] == [3.0, 30.0, 31.0, 150.0]
    # Without a pairing of times two series give every combination, as two lateral calls do.
    both = with_series(by_id, series, {"value": "other"}, "sp", "ext")
    assert both.count() == 4
    paired = with_series(by_id, series, {"value": "again"}, instance_id="ref", aligned=("timestamp", "timestamp"))
    assert paired.count() == 4 and paired.where("value <> again").count() == 0


def test_joins(spark):
    left = spark.createDataFrame([("a", "x", 1), ("b", "x", 2), ("a", "y", 3)], "space string, external_id string, n int")
    right = spark.createDataFrame([("a", "x", "1"), ("c", "x", "3"), ("a", None, "9")],
                                  "space string, parent string, n string")
    pick = lambda df: rows(df.select("l.space", "r.space"))
    assert pick(join_on_reference(left, right, "parent")) == [("a", "a"), ("a", "c"), ("b", "a"), ("b", "c")]
    assert pick(join_on_instance(left, right, "parent")) == [("a", "a")]
    assert pick(join_on_property(left, right, "n", "n")) == [("a", "a"), ("a", "c")]


@pytest.mark.parametrize("name", rollups.AGGREGATES)
def test_sql_functions_agree_with_the_operators(spark, table, name):
    table.createOrReplaceTempView("series_points")
    create_series_functions(spark, "series_points")
    arguments = f"'{RANGE[0]}', '{RANGE[1]}', '{name}', '90m'"
    ids = "s:hot,o:grid,o:one"
    got = spark.sql(f"SELECT space, external_id, timestamp, value FROM "
                    f"time_series_datapoints_detailed_udtf('{ids}', {arguments})")
    expected = {k: v for k, v in expected_rollup(name, 5400).items() if k[1] in ("hot", "grid", "one")}
    agree({tuple(r)[:3]: r.value for r in got.collect()}, expected)
    one = spark.sql(f"SELECT * FROM time_series_datapoints_udtf('s:sparse:x', {arguments})")
    agree({("s", "sparse:x", r.timestamp): r.value for r in one.collect()},
          {k: v for k, v in expected_rollup(name, 5400).items() if k[1] == "sparse:x"})
    lateral = spark.sql(f"""SELECT ids.id, ts.timestamp, ts.value FROM VALUES ('s:sparse:x'), ('o:one') AS ids(id)
        CROSS JOIN LATERAL (SELECT * FROM time_series_datapoints_udtf(ids.id, {arguments})) ts""")
    agree({(*r.id.split(":", 1), r.timestamp): r.value for r in lateral.collect()},
          {k: v for k, v in expected_rollup(name, 5400).items() if k[1] in ("sparse:x", "one")})


@pytest.mark.parametrize(
    ("call", "message"),
    [
        ("time_series_datapoints_udtf('no_colon', '0', 'now')", "instance id"),
        ("time_series_datapoints_udtf('o:one', 'lately', 'now')", "not a time"),
        ("time_series_datapoints_udtf('o:one', '0', 'now', 'median', '1d')", "unknown aggregate"),
        ("time_series_datapoints_udtf('o:one', '0', 'now', 'max')", "go together"),
        ("time_series_datapoints_detailed_udtf('o:one,x', '0', 'now')", "instance id"),
        ("time_series_datapoints_detailed_udtf('o:one', '0', 'now', granularity => '1d')", "go together"),
        ("time_series_sql_udtf('o:one', '0', 'now', 'interpolation', '1d')", "unknown aggregate"),
        ("time_series_sql_udtf('o:one', '0', 'now', NULL, '1d')", "hint"),
        ("time_series_latest_datapoints_udtf('x')", "instance id"),
    ],
)
def test_sql_function_checks(spark, table, call, message):
    table.createOrReplaceTempView("series_points")
    create_series_functions(spark, "series_points")
    with pytest.raises(Exception, match=message):
        spark.sql(f"SELECT * FROM {call}").collect()
