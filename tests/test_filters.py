"""The filter and limit cases of the survey, asserted on rows."""

from datetime import date, datetime, timezone

import pytest
from conftest import rows
from pyspark.sql import functions as F

from viewloom.model import Property, ViewDef
from viewloom.operators.filters import FilterSpec
from viewloom.operators.scan import conform, row_limit, scan

VIEW = ViewDef(
    "sp-lims",
    "LimsResults",
    "v1",
    (
        Property("TestSeqNumber"),
        Property("DilutionFactor", "float64"),
        Property("tags", is_list=True),
        Property("boat_guid", "int64"),
        Property("seen", "timestamp"),
        Property("day", "date"),
        Property("ok", "boolean"),
    ),
)
DATA = [
    ("5889450", 1.5, ["alpha", "beta"], 10, datetime(2024, 1, 1), date(2024, 1, 1), True, "space-a", "r1"),
    ("a", None, ["gamma"], 20, datetime(2024, 1, 2), date(2024, 1, 2), False, "space-b", "r2"),
    ("b", 2.5, None, 101, datetime(2024, 1, 3, 12), date(2024, 1, 3), None, "space-c", "my-id"),
    (None, None, [], None, None, None, True, "space-a", "r4"),
]


@pytest.fixture(scope="module")
def table(spark):
    schema = """TestSeqNumber string, DilutionFactor double, tags array<string>, boat_guid bigint, seen timestamp,
        day date, ok boolean, space string, external_id string"""
    return conform(spark.createDataFrame(DATA, schema), VIEW).cache()


def ids(table, **spec):
    return [r[0] for r in rows(scan(table, VIEW, FilterSpec(**spec), ["external_id"]))]


CASES = [
    (dict(equals={"TestSeqNumber": "5889450"}), ["r1"]),
    (dict(equals={"TestSeqNumber": '["a", "b"]'}), ["my-id", "r2"]),
    (dict(equals={"TestSeqNumber": ["a"]}), ["r2"]),
    (dict(equals={"TestSeqNumber": None}), ["my-id", "r1", "r2", "r4"]),
    (dict(equals={"TestSeqNumber": '{"a": 1}'}), []),
    (dict(equals={"tags": "alpha"}), ["r1"]),
    (dict(equals={"tags": ["beta", "gamma"]}), ["r1", "r2"]),
    (dict(equals={"boat_guid": "20"}), ["r2"]),
    (dict(equals={"boat_guid": 20.0}), ["r2"]),
    (dict(equals={"boat_guid": 20.5}), []),
    (dict(equals={"ok": "true"}), ["r1", "r4"]),
    (dict(equals={"ok": False}), ["r2"]),
    (dict(exists='["DilutionFactor"]'), ["my-id", "r1"]),
    (dict(exists="DilutionFactor"), ["my-id", "r1"]),
    (dict(not_exists=["DilutionFactor"]), ["r2", "r4"]),
    (dict(equals={"TestSeqNumber": "5889450"}, exists=["DilutionFactor"]), ["r1"]),
    (dict(instance_space="space-a"), ["r1", "r4"]),
    (dict(instance_space='["space-a", "space-b"]'), ["r1", "r2", "r4"]),
    (dict(instance_space="sp-lims"), []),
    (dict(external_id="my-id"), ["my-id"]),
    (dict(external_id=["my-id", "r4", "none"]), ["my-id", "r4"]),
    (dict(gt='{"boat_guid": 100}'), ["my-id"]),
    (dict(gte={"boat_guid": 10}, lt={"boat_guid": 20}), ["r1"]),
    (dict(gt={"boat_guid": 10.5}), ["my-id", "r2"]),
    (dict(gte={"boat_guid": 20}, lte={"boat_guid": None}), ["my-id", "r2"]),
    (dict(gte={"seen": date(2024, 1, 2)}), ["my-id", "r2"]),
    (dict(gt={"seen": datetime(2024, 1, 3, 11, tzinfo=timezone.utc)}), ["my-id"]),
    (dict(lt={"seen": "2024-01-02T00:00:00Z"}), ["r1"]),
    (dict(equals={"day": "2024-01-02"}), ["r2"]),
    (dict(), ["my-id", "r1", "r2", "r4"]),
    (dict(equals={"TestSeqNumber": "b"}, exists='["tags"]', instance_space="space-c", gt='{"boat_guid": 1}'), []),
    (
        dict(equals={"TestSeqNumber": "a"}, exists='["tags"]', instance_space='["space-b"]', gt='{"boat_guid": 1}'),
        ["r2"],
    ),
]


@pytest.mark.parametrize(("spec", "expected"), CASES)
def test_filters(table, spec, expected):
    assert ids(table, **spec) == expected


def test_unknown_property_is_an_error(table):
    with pytest.raises(ValueError, match="no property"):
        ids(table, equals={"nope": 1})


def test_limits(table):
    assert [row_limit(v) for v in (None, "x", -1, "7", 0, 3.9)] == [None, None, None, 7, 0, 3]
    assert scan(table, VIEW, limit=2).count() == 2
    assert scan(table, VIEW, limit=0).count() == 0
    assert scan(table, VIEW, limit=-1).count() == 4


def test_conform_picks_nodes_or_edges(spark):
    data = spark.createDataFrame([("node", "s", "n", "x"), ("edge", "s", "e", "y")],
                                 "instance_type string, space string, external_id string, class string")
    for used_for, expected in (("node", "n"), ("edge", "e"), ("all", "n")):
        view = ViewDef("m", "V", "v1", (Property("class"),), used_for)
        got = conform(data, view)
        assert [r.external_id for r in got.collect()] == [expected]
        assert got.columns == view.columns


def test_filters_on_a_stream_need_no_other_code(spark, tmp_path):
    """Scans are narrow, so the same call works on a streaming table."""
    source, sink = str(tmp_path / "in"), "filtered_stream"
    spark.createDataFrame([("x", "s", "a"), ("y", "s", "b")], "name string, space string, external_id string") \
        .write.parquet(source)
    view = ViewDef("m", "V", "v1", (Property("name"),))
    stream = spark.readStream.schema("name string, space string, external_id string").parquet(source)
    kept = scan(conform(stream, view), view, FilterSpec(equals={"name": "y"}))
    query = kept.writeStream.format("memory").queryName(sink).start()
    query.processAllAvailable()
    query.stop()
    assert [r.external_id for r in spark.table(sink).select(F.col("external_id")).collect()] == ["b"]
