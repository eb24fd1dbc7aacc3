"""SQL views and view table functions."""

import pytest
from conftest import rows

from viewloom.model import Property, ViewDef
from viewloom.operators.scan import conform
from viewloom.plans.sql_surface import create_view_function, create_views, view_ddl, view_function_ddl

VIEW = ViewDef(
    "sailboat",
    "SmallBoat",
    "v1",
    (
        Property("name"),
        Property("class"),
        Property("guid", "int64"),
        Property("tags", is_list=True),
        Property("built", "timestamp"),
        Property("length", "float64"),
        Property("fast", "boolean"),
    ),
)
DATA = [
    ("MyBoat", "c1", 10, ["red", "big"], "2024-01-01", 7.5, True, "a", "b1"),
    ("Other", "c1", 20, ["blue"], "2024-02-01", 9.0, False, "a", "b2"),
    (None, "c2", None, None, None, None, None, "b", "b3"),
    ("[C]", "c3", None, None, None, None, None, "c", "b4"),
]


@pytest.fixture(scope="module")
def boats(spark):
    schema = """name string, class string, guid bigint, tags array<string>, built string, length double, fast boolean,
        space string, external_id string"""
    table = spark.createDataFrame(DATA, schema).selectExpr("* except (built)", "CAST(built AS TIMESTAMP) AS built")
    conform(table, VIEW).createOrReplaceTempView("boat_rows")
    create_views(spark, {"boat_rows": VIEW})
    create_view_function(spark, VIEW, "boat_rows")
    return spark


def ids(spark, arguments):
    return [r[0] for r in rows(spark.sql(f"SELECT external_id FROM small_boat_udtf({arguments})"))]


@pytest.mark.parametrize(
    ("arguments", "expected"),
    [
        ("", ["b1", "b2", "b3", "b4"]),
        ("NULL, NULL", ["b1", "b2", "b3", "b4"]),
        ("'MyBoat'", ["b1"]),
        ("NULL, 'c1', NULL, 'blue'", ["b2"]),
        ("name => 'MyBoat'", ["b1"]),
        ("name => '[\"MyBoat\", \"Other\"]'", ["b1", "b2"]),
        ("class_ => 'c2'", ["b3"]),
        ("guid => 20", ["b2"]),
        ("guid => '[10, 20]'", ["b1", "b2"]),
        ("tags => '[\"red\", \"blue\"]'", ["b1", "b2"]),
        ("tags => 'big'", ["b1"]),
        ("fast => true", ["b1"]),
        ("built => TIMESTAMP '2024-02-01 00:00:00'", ["b2"]),
        ("_exists => 'guid'", ["b1", "b2"]),
        ("_not_exists => '[\"guid\", \"name\"]'", ["b3"]),
        ("_exists => '[\"class\"]', instance_space => '[\"b\"]'", ["b3"]),
        ("instance_space => 'a', external_id => '[\"b1\", \"b3\"]'", ["b1"]),
        ("_gt => '{\"guid\": 10}'", ["b2"]),
        ("_gte => '{\"guid\": 10}', _lt => '{\"guid\": 20, \"length\": 8}'", ["b1"]),
        ("_lte => '{\"built\": \"2024-01-15T00:00:00Z\"}'", ["b1"]),
        ("name => '[A] pump'", []),
        ("name => '[C]'", ["b4"]),
        ("name => '[\"[C]\", \"MyBoat\"]'", ["b1", "b4"]),
        ("_gt => '{\"guid\": 9.5}'", ["b1", "b2"]),
        ("_lt => '{\"guid\": 10.5}'", ["b1"]),
        ("_gte => '{\"guid\": 10.5}', _lte => '{\"guid\": 20.5}'", ["b2"]),
        ("guid => '10.5'", []),
        ("guid => '[10.5, 20]'", ["b2"]),
        ("guid => '10.0'", ["b1"]),
        ("_exists => 'class_', _not_exists => 'guid'", ["b3", "b4"]),
        ("_exists => '[]'", ["b1", "b2", "b3", "b4"]),
        ("_row_limit => 0", []),
        ("_row_limit => -1", ["b1", "b2", "b3", "b4"]),
        ("_query_mode => 'LIST', name => 'Other'", ["b2"]),
    ],
)
def test_list_mode(boats, arguments, expected):
    assert ids(boats, arguments) == expected


@pytest.mark.parametrize("limit", [1, 2, 3, 4, 9])
def test_row_limits_take_the_same_rows_again(boats, limit):
    first = ids(boats, f"_row_limit => {limit}")
    assert len(first) == min(limit, 4) and first == ids(boats, f"_row_limit => {limit}")
    assert set(first) <= set(ids(boats, f"_row_limit => {limit + 1}"))


@pytest.mark.parametrize(
    ("arguments", "message"),
    [
        ("_exists => 'typo'", "lacks some name"),
        ("_not_exists => '[\"name\", \"typo\"]'", "lacks some name"),
        ("_gt => '{\"typo\": 5}'", "lacks some name"),
        ("_lte => 'guid'", "no JSON object"),
        ("_gt => '{\"guid\": '", "no JSON object"),
        ("_group_by => 'class'", "no JSON list"),
        ("_group_by => '[\"typo\"]'", "lacks some name"),
    ],
)
def test_wrong_arguments_fail(boats, arguments, message):
    with pytest.raises(Exception, match=message):
        ids(boats, arguments)


def test_same_columns_as_the_view(boats):
    assert boats.sql("SELECT * FROM small_boat_udtf()").schema.fieldNames() == VIEW.columns
    assert boats.sql("SELECT * FROM SmallBoat").schema.fieldNames() == VIEW.columns
    assert rows(boats.sql("SELECT external_id FROM SmallBoat WHERE guid > 5 AND class_ = 'c1'")) == [("b1",), ("b2",)]


def aggregate(boats, metrics, *more):
    extra = "".join(f", {m}" for m in more)
    return boats.sql(f"SELECT * FROM small_boat_udtf(_query_mode => 'aggregate', _aggregates => '{metrics}'{extra})")


COUNT = '{"fn": "count", "property": "externalId"}'


def test_aggregate_mode(boats):
    [row] = aggregate(boats, f'[{COUNT}, {{"fn": "MAX", "property": "guid"}}, {{"fn": ""}}]').collect()
    assert (row.external_id, row.guid, row.name, row.space) == ("4", 20, None, None)
    [row] = aggregate(boats, f'[{COUNT}]', "name => 'nobody'").collect()
    assert row.external_id == "0"
    grouped = aggregate(boats, f'[{COUNT}, {{"fn": "min", "property": "length"}}]', "_group_by => '[\"class\", \"space\"]'")
    assert rows(grouped.select("class_", "space", "external_id", "length")) == [
        ("c1", "a", "2", 7.5), ("c2", "b", "1", None), ("c3", "c", "1", None)]
    by_id = aggregate(boats, '[{"fn": "count", "property": "name"}]', "_group_by => '[\"externalId\"]'")
    assert rows(by_id.select("external_id", "name")) == [("b1", "1"), ("b2", "1"), ("b3", "0"), ("b4", "1")]


@pytest.mark.parametrize(
    ("metrics", "message"),
    [
        ("[" + ",".join([COUNT] * 6) + "]", "at most 5"),
        ("[]", "needs a list"),
        ('[{"fn": "min", "property": "name"}]', "numeric"),
        ('[{"fn": "sum", "property": "guid"}]', "count, or min or max"),
        ('[{"fn": "count", "property": "nope"}]', "count, or min or max"),
    ],
)
def test_aggregate_checks(boats, metrics, message):
    with pytest.raises(Exception, match=message):
        aggregate(boats, metrics).collect()


def test_statements_for_a_catalog():
    assert view_ddl(VIEW, "db.boats", "db.small_boat", temporary=False).startswith(
        "CREATE OR REPLACE VIEW `db`.`small_boat` AS SELECT `name`, `class_`")
    assert "CREATE OR REPLACE FUNCTION `small_boat_udtf`(`name` STRING DEFAULT NULL" in view_function_ddl(
        VIEW, "db.boats", temporary=False)
