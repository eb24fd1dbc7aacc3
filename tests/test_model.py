import pytest
from pyspark.sql import types as T

from viewloom.model import Property, ViewDef, function_name_for, spark_type_for


@pytest.mark.parametrize(
    ("source", "is_list", "expected"),
    [
        ("int32", False, "bigint"),
        ("int64", False, "bigint"),
        ("float32", False, "double"),
        ("float64", True, "array<double>"),
        ("boolean", False, "boolean"),
        ("timestamp", True, "array<timestamp>"),
        ("date", False, "date"),
        ("text", True, "array<string>"),
        ("direct_relation", True, "string"),
        ("reverse_direct_relation", False, "string"),
        ("json", False, "string"),
    ],
)
def test_types(source, is_list, expected):
    assert spark_type_for(source, is_list).simpleString() == expected


def test_reserved_names_get_an_underscore_and_keep_their_key():
    view = ViewDef("m", "V", "v1", (Property("class"), Property("name"), Property("space")))
    assert view.columns == ["class_", "name", "space_", "space", "external_id", "createdTime", "lastUpdatedTime",
                            "deletedTime"]
    assert view.schema["class_"].metadata == {"source_key": "class"}
    assert view.require("class").need_alias and not view.require("name").need_alias


def test_schema_nullability_and_kind():
    view = ViewDef("m", "V", "v1", (Property("n", "int64", nullable=False),), used_for="all")
    assert not view.schema["n"].nullable and not view.schema["space"].nullable
    assert view.schema["deletedTime"] == T.StructField("deletedTime", T.TimestampType(), True)
    assert view.instance_type == "node"
    assert ViewDef("m", "E", "v1", used_for="edge").instance_type == "edge"
    with pytest.raises(ValueError):
        ViewDef("m", "V", "v1", (Property("a"), Property("a")))


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("SmallBoat", "small_boat_udtf"),
        ("small_boat", "small_boat_udtf"),
        ("small_boat_udtf", "small_boat_udtf"),
        ("Boat3D", "boat_3d_udtf"),
        ("HTTPResponse", "http_response_udtf"),
    ],
)
def test_function_names(name, expected):
    assert function_name_for(name) == expected
