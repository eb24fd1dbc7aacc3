import json
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewloom.functions.coercion import UNCLEAR_LINE, UNCLEAR_TEXT, unclear_texts
from viewloom.model import Property, ViewDef
from viewloom.sources.payloads import unnest_payloads
from viewloom.sources.records import parse_items, read_pages, resolve, unnest_pages
from workload.records import resolve_wide

VIEW = ViewDef(
    "sailboat",
    "SmallBoat",
    "v1",
    (Property("name"), Property("sourceCreatedTime", "timestamp"), Property("aph_tod", "float64"), Property("class")),
)
KEY = VIEW.view_key


def item(**more):
    return {"space": "inst", "externalId": "b1", "createdTime": 1704067200000, "lastUpdatedTime": 0, **more}


def resolved(spark, *items, view=VIEW):
    df = spark.createDataFrame([(json.dumps(i),) for i in items], "record string")
    return resolve(parse_items(df, view), view)


def source(properties, external_id="SmallBoat", version="v1", space="sailboat"):
    return {"source": {"space": space, "externalId": external_id, "version": version}, "properties": properties}


CASES = [
    # own space, then other spaces only if it gives nothing
    (item(properties={"sailboat": {KEY: {"name": "A", "aph_tod": 1}}}), ("A", None, 1.0, None)),
    (item(properties={"x": {KEY: {"name": "X"}}, "sailboat": {KEY: {"name": "A"}}}), ("A", None, None, None)),
    (item(properties={"z": {KEY: {"name": "Z"}}, "a": {KEY: {"name": "B"}}}), ("Z", None, None, None)),
    (item(properties={"sailboat": {KEY: {}}, "a": {KEY: {"name": "B"}}}), (None, None, None, None)),
    (item(properties={"a": {KEY: {"name": "B"}}, "sailboat": {KEY: {}}}), ("B", None, None, None)),
    (item(properties={"sailboat": {KEY: {"other": 1}}, "a": {KEY: {"name": "B"}}}), (None, None, None, None)),
    (item(properties={"sailboat": {KEY: {"name": None}}, "a": {KEY: {"name": "B"}}}), (None, None, None, None)),
    (item(properties={"sailboat": {"SmallBoat/v2": {"name": "old"}}}), (None, None, None, None)),
    # sources as a list: non-null values win, the last entry of the view wins among them
    (
        item(properties={"sailboat": {KEY: {"name": "A", "class": "k"}}},
             sources=[source({"name": "S", "class": None}), source({"name": "no"}, version="v2")]),
        ("S", None, None, "k"),
    ),
    (item(sources=[source({"name": "1", "aph_tod": 2}), source({"name": "2"})]), ("2", None, 2.0, None)),
    (item(sources=[{"source": {"space": "sailboat", "external_id": "SmallBoat", "version": "v1"},
                    "properties": {"name": "S"}}, 5, {"source": 5}]), ("S", None, None, None)),
    (item(sources=[source({"name": "no"}, space="other")]), (None, None, None, None)),
    # sources as a map
    (item(properties={"sailboat": {KEY: {"name": "A", "aph_tod": 3}}}, sources={KEY: {"name": "M", "aph_tod": None}}),
     ("M", None, 3.0, None)),
    # top level, where the view has no value
    (item(name="T", **{"class": "c"}, properties={"sailboat": {KEY: {"name": None}}}), ("T", None, None, "c")),
    (item(sourceCreatedTime=1704067200000), (None, datetime(2024, 1, 1), None, None)),
    (item(), (None, None, None, None)),
]


@pytest.mark.parametrize(("record", "expected"), CASES)
def test_resolution(spark, record, expected):
    got = resolved(spark, record)
    assert got.columns == VIEW.columns
    [row] = got.collect()
    assert tuple(row) == (*expected, "inst", "b1", datetime(2024, 1, 1), datetime(1970, 1, 1), None)


def test_identity_and_kind(spark):
    items = [
        {"instanceType": "node", "space": "s", "external_id": "n"},
        {"instanceType": "edge", "space": "s", "externalId": "e"},
        {"space": "s", "externalId": "", "external_id": "d"},
    ]
    assert [r.external_id for r in resolved(spark, *items).orderBy("external_id").collect()] == ["d", "n"]
    edges = ViewDef("sailboat", "Edge", "v1", (Property("name"),), used_for="edge")
    assert [r.external_id for r in resolved(spark, *items, view=edges).collect()] == ["e"]


def test_page_files(spark, tmp_path):
    pages = [
        {"items": [item(properties={"sailboat": {KEY: {"name": "A"}}}), item(externalId="b2")], "nextCursor": "c"},
        {"items": []},
        {"nextCursor": None},
    ]
    for i, page in enumerate(pages):
        (tmp_path / f"{i}.json").write_text(json.dumps(page, indent=1))
    got = resolve(unnest_pages(read_pages(spark, str(tmp_path)), VIEW), VIEW)
    assert rows(got.select("name", "external_id")) == [("A", "b1"), (None, "b2")]


@pytest.mark.parametrize("columns", [0, 1, 20])
def test_wide_views(spark, columns):
    view = ViewDef("m", "WideView", "v1", tuple(Property(f"prop{i}") for i in range(columns)))
    record = item(properties={"m": {view.view_key: {f"prop{i}": f"v{i}" for i in range(columns)}}})
    [row] = resolved(spark, record, view=view).collect()
    assert list(row)[:columns] == [f"v{i}" for i in range(columns)]


def test_payloads(spark):
    status = {"code": 3, "symbol": "Good"}
    items = [
        {"instanceId": {"space": "s", "externalId": "n"},
         "numericDatapoints": {"datapoints": [{"timestamp": 0, "value": 1.5, "status": status},
                                              {"timestamp": 1000, "value": 2}]}},
        {"instanceId": {"space": "s", "externalId": "t"},
         "stringDatapoints": {"datapoints": [{"timestamp": 1000, "value": "on"}]}},
        {"aggregateDatapoints": {"datapoints": [{"timestamp": 1000, "average": 7, "stepInterpolation": 8}]}},
        {"instanceId": {"space": "s", "externalId": "empty"}, "numericDatapoints": {"datapoints": []}},
    ]
    df = spark.createDataFrame([(json.dumps({"items": items}),), ("{}",)], "payload string")
    zero, one = datetime(1970, 1, 1), datetime(1970, 1, 1, 0, 0, 1)
    expected = [
        (zero, 1.5, None, 3, "Good", "n", "s"),
        (one, 2.0, None, None, None, "n", "s"),
        (one, None, "on", None, None, "t", "s"),
        (one, 7.0, None, None, None, "", ""),
    ]
    assert rows(unnest_payloads(df)) == sorted(expected, key=repr)
    step = unnest_payloads(df, aggregate="stepInterpolation").where("external_id = ''")
    assert [r.value for r in step.collect()] == [8.0]
    with pytest.raises(ValueError):
        unnest_payloads(df, aggregate="median")


MIXED = ViewDef(
    "m", "Mixed", "v1",
    (Property("t"), Property("l", "int64"), Property("d", "float64"), Property("b", "boolean"), Property("at", "timestamp"),
     Property("day", "date"), Property("r", "direct_relation")),
)
# One value each: what a text can't tell apart is read from the JSON type.
DOUBTS = [
    ("t", 1.5, "1.5"), ("t", "1.50", "1.50"), ("t", 7, "7"), ("t", "[1,  2]", "[1, 2]"), ("t", {"z": 1, "a": [1, "x,y"]}, '{"z": 1, "a": [1, "x,y"]}'),
    ("t", {"externalId": "x"}, "x"), ("t", "{space=s, externalId=y}", "y"), ("t", True, "true"), ("t", "", ""),
    ("l", 1.9, 1), ("l", "1.9", None), ("l", " 12 ", 12), ("l", True, 1), ("d", "1e3", 1000.0), ("d", 2, 2.0), ("d", "x", None),
    ("b", 2, True), ("b", "2", False), ("b", 1, True), ("b", "YES", True), ("b", False, False),
    ("at", 1704067200000, datetime(2024, 1, 1)), ("at", "1704067200000", None), ("at", "2024-01-01T02:00:00+02:00", datetime(2024, 1, 1)),
    ("at", 0, datetime(1970, 1, 1)), ("day", "2024-01-02", datetime(2024, 1, 2).date()), ("day", 86400000, datetime(1970, 1, 2).date()),
    ("r", {"space": "s", "externalId": "x"}, "x"), ("r", {"external_id": "x"}, "x"), ("r", '{"externalId":"x"}', '{"externalId":"x"}'),
    ("r", "plain", "plain"), ("r", {"other": 1}, '{"other": 1}'),
]


def test_doubtful_texts(spark):
    items = [item(externalId=str(i), properties={"m": {MIXED.view_key: {name: value}}}) for i, (name, value, _) in enumerate(DOUBTS)]
    got = {int(r.external_id): r for r in resolved(spark, *items, view=MIXED).collect()}
    assert {i: got[i][name] for i, (name, _, _) in enumerate(DOUBTS)} == {i: want for i, (_, _, want) in enumerate(DOUBTS)}


def test_lines_of_texts_hold_every_unclear_text(spark):
    texts = [
        "1.5", "1.5\n", "1.5\r", "1.5\r\n", "-0", "-0 ", "1e3", "-1.25E-3", "1" * 30, " {", "\n\n [x", "\t[", "a[", "7", "1.5x", "x\n1.5", "", "\n",
        "-", "1.", "-00", "1.5e", "é{", "\u0085[",
    ]
    df = spark.createDataFrame([(left, text, right) for text in texts for left in texts for right in (None, "a\r")], "l string, t string, r string")
    columns = [df[c] for c in "ltr"]
    singly = F.exists(F.array(*columns), lambda t: F.coalesce(t.rlike(UNCLEAR_TEXT), F.lit(False)))
    assert df.where(singly & ~F.concat_ws("\n", *columns).rlike(UNCLEAR_LINE)).count() == 0
    assert df.where(singly != unclear_texts(columns, T.StringType(), F.lit(""))).count() == 0


def test_wide_records_stay_whole(spark):
    """Fields of wide items are not made one by one by a generator, which is not compiled, and the input is dealt out."""
    view = ViewDef("m", "WideView", "v1", tuple(Property(f"prop{i}") for i in range(150)))
    df = resolved(spark, item(properties={"m": {view.view_key: {"prop1": "x"}}}), view=view)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    generators = [line for line in plan.splitlines() if "Generate " in line]
    assert len(generators) == 2
    assert not [line for line in generators if "struct(" in line or "named_struct(" in line]


def test_resolve_wide_deals_out_orders(spark, tmp_path):
    rows = [(i, "O", datetime(1996, 1, 1)) for i in range(400)]
    orders = spark.createDataFrame(rows, "o_orderkey long, o_orderstatus string, o_orderdate timestamp_ntz")
    orders.coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    got = resolve_wide(spark, str(tmp_path)).select("external_id", "field3", F.spark_partition_id().alias("part")).collect()
    assert len({r.part for r in got}) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted((r.external_id, r.field3) for r in got) == sorted((f"order_{i}", f"3:{i}" if (i + 3) % 7 else None) for i in range(400))
