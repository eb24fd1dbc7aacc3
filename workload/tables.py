"""How the given tables look as views and datapoints, in Spark and as the matching SQL.

Each mapping only renames and derives columns, so filters and column pruning still reach the Parquet scan.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewloom.model import Property, ViewDef
from viewloom.operators.scan import conform

# The events cover January 2024; every query with relative times takes this instant as now.
NOW = datetime(2024, 1, 31, tzinfo=timezone.utc)
START, END = "30d-ago", "now"

ORDER_VIEW = ViewDef(
    "sales",
    "OrderView",
    "v1",
    (
        Property("status"),
        Property("totalPrice", "float64"),
        Property("orderDate", "timestamp"),
        Property("class"),
        Property("customer", "direct_relation"),
        Property("shipNote"),
        Property("clerk", "int64"),
    ),
)
CUSTOMER_VIEW = ViewDef(
    "sales",
    "CustomerView",
    "v1",
    (Property("name"), Property("balance", "float64"), Property("nation", "int64"), Property("segment")),
)
PART_VIEW = ViewDef(
    "sales",
    "PartView",
    "v1",
    (
        Property("brand"),
        Property("tags", "text", is_list=True),
        Property("size", "int64"),
        Property("retailPrice", "float64"),
    ),
)
USER_VIEW = ViewDef(
    "sales",
    "UserView",
    "v1",
    (
        Property("name"),
        Property("viewSeriesSpace"),
        Property("viewSeries"),
        Property("clickSeries"),
    ),
)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    table = read(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("totalPrice"),
        F.col("o_orderdate").alias("orderDate"),
        F.col("o_orderpriority").alias("class"),
        F.concat(F.lit("customer_"), "o_custkey").alias("customer"),
        F.when(key % 5 != 0, F.concat(F.lit("note "), key)).alias("shipNote"),
        F.when(key % 7 != 0, F.pmod(key, F.lit(40))).alias("clerk"),
        F.col("o_orderstatus").alias("space"),
        F.concat(F.lit("order_"), key).alias("external_id"),
    )
    return conform(table, ORDER_VIEW)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_nationkey").cast("bigint").alias("nation"),
        F.col("c_mktsegment").alias("segment"),
        F.concat(F.lit("shard_"), F.pmod("c_custkey", F.lit(4))).alias("space"),
        F.concat(F.lit("customer_"), "c_custkey").alias("external_id"),
    )
    return conform(table, CUSTOMER_VIEW)


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read(spark, sf_dir, "part").select(
        F.col("p_brand").alias("brand"),
        F.split("p_name", " ").alias("tags"),
        F.col("p_size").cast("bigint").alias("size"),
        F.col("p_retailprice").alias("retailPrice"),
        F.col("p_type").alias("space"),
        F.concat(F.lit("part_"), "p_partkey").alias("external_id"),
    )
    return conform(table, PART_VIEW)


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer, referring to the event series that carry the customer's key as user."""
    ref = F.concat(F.lit("user_"), "c_custkey")
    table = read(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"),
        F.when(F.col("c_custkey") % 3 != 0, F.lit("view")).alias("viewSeriesSpace"),
        F.when(F.col("c_custkey") % 3 != 0, ref).alias("viewSeries"),
        F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("click:"), ref)).alias("clickSeries"),
        F.col("c_mktsegment").alias("space"),
        F.concat(F.lit("customer_"), "c_custkey").alias("external_id"),
    )
    return conform(table, USER_VIEW)


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.get_json_object("props", "$.k").cast("int")
    return read(spark, sf_dir, "events").select(
        F.col("event_type").alias("space"),
        F.concat(F.lit("user_"), "user_id").alias("external_id"),
        "ts",
        "value",
        code.alias("status_code"),
        F.when(code < 50, "Good").when(code < 80, "Uncertain").otherwise("Bad").alias("status_symbol"),
    )


ORDERS_SQL = """(SELECT o_orderstatus AS "status", o_totalprice AS "totalPrice", o_orderdate AS "orderDate",
    o_orderpriority AS class_, 'customer_' || o_custkey AS customer,
    CASE WHEN o_orderkey % 5 <> 0 THEN 'note ' || o_orderkey END AS "shipNote",
    CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 40 END AS clerk,
    o_orderstatus AS space, 'order_' || o_orderkey AS external_id,
    CAST(NULL AS TIMESTAMP) AS "createdTime", CAST(NULL AS TIMESTAMP) AS "lastUpdatedTime",
    CAST(NULL AS TIMESTAMP) AS "deletedTime" FROM orders)"""
CUSTOMERS_SQL = """(SELECT c_name AS name, c_acctbal AS balance, CAST(c_nationkey AS BIGINT) AS nation,
    c_mktsegment AS segment, 'shard_' || (c_custkey % 4) AS space, 'customer_' || c_custkey AS external_id
    FROM customer)"""
PARTS_SQL = """(SELECT p_brand AS brand, string_split(p_name, ' ') AS tags, CAST(p_size AS BIGINT) AS size,
    p_retailprice AS "retailPrice", p_type AS space, 'part_' || p_partkey AS external_id FROM part)"""
USERS_SQL = """(SELECT c_name AS name, CASE WHEN c_custkey % 3 <> 0 THEN 'view' END AS view_space,
    CASE WHEN c_custkey % 3 <> 0 THEN 'user_' || c_custkey END AS view_id,
    CASE WHEN c_custkey % 2 = 0 THEN 'click' END AS click_space,
    CASE WHEN c_custkey % 2 = 0 THEN 'user_' || c_custkey END AS click_id,
    c_mktsegment AS space, 'customer_' || c_custkey AS external_id FROM customer)"""
POINTS_SQL = """(SELECT event_type AS space, 'user_' || user_id AS external_id, ts, value,
    CAST(json_extract(props, '$.k') AS INTEGER) AS status_code,
    CASE WHEN CAST(json_extract(props, '$.k') AS INTEGER) < 50 THEN 'Good'
         WHEN CAST(json_extract(props, '$.k') AS INTEGER) < 80 THEN 'Uncertain' ELSE 'Bad' END AS status_symbol
    FROM events)"""
