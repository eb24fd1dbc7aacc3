"""Permanent functions and views over catalog tables, made in one session and called from another."""

import pytest
from conftest import rows
from pyspark.errors import AnalysisException

from viewloom.model import Property, ViewDef
from viewloom.plans.sql_surface import create_catalog_functions

BOAT = ViewDef("sailboat", "CatalogBoat", "v1", (Property("name"), Property("guid", "int64")))


@pytest.fixture()
def catalog(spark, tmp_path):
    spark.sql(f"CREATE DATABASE fleet LOCATION 'file://{tmp_path}/fleet'")
    boats = [("One", 1, "s", "x1", None, None, None), ("Two", 2, "s", "x2", None, None, None), ("Two", 3, "t", "x3", None, None, None)]
    columns = "name string, guid bigint, space string, external_id string, createdTime timestamp, lastUpdatedTime timestamp, deletedTime timestamp"
    spark.createDataFrame(boats, columns).write.saveAsTable("fleet.boats")
    points = spark.sql("SELECT 's' AS space, 'x1' AS external_id, timestamp_seconds(id * 60) AS ts, double(id) AS value FROM range(120)")
    points.write.saveAsTable("fleet.points")
    yield "fleet"
    spark.sql("DROP DATABASE fleet CASCADE")


def test_called_from_a_second_session(spark, catalog):
    made = create_catalog_functions(spark, catalog, {"fleet.boats": BOAT}, "fleet.points")
    assert "fleet.catalog_boat_udtf" in made and "fleet.time_series_sql_udtf" in made and "fleet.CatalogBoat" in made
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "UTC")
    other.sql(f"USE {catalog}")
    boats = other.sql("SELECT external_id FROM catalog_boat_udtf(name => 'Two', _gt => '{\"guid\": 2}')")
    assert rows(boats) == [("x3",)]
    assert rows(other.sql("SELECT space, external_id FROM fleet.CatalogBoat WHERE name = 'Two'")) == [("s", "x2"), ("t", "x3")]
    grouped = "SELECT space, external_id FROM catalog_boat_udtf(_query_mode => 'aggregate', _aggregates => '[{\"fn\": \"count\", \"property\": \"externalId\"}]', _group_by => '[\"space\"]')"
    assert rows(other.sql(grouped)) == [("s", "2"), ("t", "1")]
    sums = "SELECT value FROM time_series_sql_udtf('s:x1', '0', '7200000', 'sum', '1h')"
    assert rows(other.sql(sums)) == [(1770.0,), (5370.0,)]
    raw = "SELECT value FROM time_series_datapoints_udtf('s:x1', '60000', '180000')"
    assert rows(other.sql(raw)) == [(1.0,), (2.0,)]
    latest = "SELECT * FROM time_series_latest_datapoints_udtf('s:x1', before => '600000')"
    assert [r["value"] for r in other.sql(latest).collect()] == [9.0]
    with pytest.raises(AnalysisException):
        other.sql("SELECT * FROM catalog_boat_udtf(nonsense => 1)")


def test_functions_follow_their_tables(spark, catalog):
    """Rows that are added later are seen, and making the functions again replaces them."""
    for _ in range(2):
        create_catalog_functions(spark, catalog, {"fleet.boats": BOAT}, "fleet.points")
    spark.sql("INSERT INTO fleet.boats VALUES ('Three', 4, 's', 'x4', NULL, NULL, NULL)")
    other = spark.newSession()
    other.sql(f"USE {catalog}")
    assert rows(other.sql("SELECT external_id FROM catalog_boat_udtf(name => 'Three')")) == [("x4",)]
