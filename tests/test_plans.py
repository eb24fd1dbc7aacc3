"""Physical plans: what reaches the scan, how many shuffles there are, and that no Python runs in a task."""

import re

import pytest

import __spark_entry__ as spark_entry
from viewloom.operators.aggregates import Metric, aggregate
from viewloom.operators.datapoints import datapoints_detailed
from viewloom.operators.filters import FilterSpec
from viewloom.operators.scan import scan
from workload import MODULES
from workload.tables import ORDER_VIEW, orders, points

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module", autouse=True)
def whole_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_filters_and_columns_reach_the_scan(spark):
    spec = FilterSpec(
        equals={"class": ["1-URGENT", "2-HIGH"]}, instance_space=["O"], gt={"totalPrice": 5}, gte={"orderDate": "0"}
    )
    text = plan(scan(orders(spark, SF), ORDER_VIEW, spec, ["totalPrice"]))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)
    for part in ("EqualTo(o_orderstatus,O)", "GreaterThan(o_totalprice,5.0)", "GreaterThanOrEqual(o_orderdate",
                 "In(o_orderpriority, [1-URGENT,2-HIGH])"):
        assert part in pushed
    read = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert sorted(c.split(":")[0] for c in read.split(",")) == [
        "o_orderdate", "o_orderpriority", "o_orderstatus", "o_totalprice"]


def test_aggregates_combine_before_their_only_shuffle(spark):
    text = plan(aggregate(orders(spark, SF), ORDER_VIEW, [Metric("count", "externalId")], ["class"]))
    assert text.count("Exchange") == 1 and "partial_count" in text


@pytest.mark.parametrize(
    ("name", "shuffles"),
    [
        ("series_average", 1),
        ("series_discrete_variance", 1),
        ("latest_datapoint", 1),
        ("series_total_variation", 2),
        ("tvf_named", 0),
        ("tvf_positional", 0),
        ("tvf_series", 0),
        ("filter_conjunction", 0),
    ],
)
def test_shuffles(spark, name, shuffles):
    text = plan(spark_entry.queries()[name](spark, SF))
    assert len(re.findall(r"Exchange (?:hash|range|Single)", text)) == shuffles
    assert "SortAggregate" not in text


def test_top_k_and_row_limit_do_not_sort_everything(spark):
    for name in ("top_k", "group_cap"):
        assert "TakeOrdered" in plan(spark_entry.queries()[name](spark, SF)), name


def test_row_limits_have_one_plan_and_rank_one_bucket(spark):
    shapes = []
    for limit in (40, 1001, 100_000):
        spark_entry.queries()["tvf_row_limit"](spark, SF)
        text = plan(spark.sql(f"SELECT external_id, space FROM order_view_udtf(_row_limit => {limit})"))
        text = re.sub(r"#\d+L?|plan_id=\d+|[(]\d+[)]|\b_\w+_\d+\b", "", text).replace(str(limit), "LIMIT")
        shapes.append(re.sub(r"\d+", "", text))
        for line in re.findall(r"Window .*", text):
            assert "sum(_n" in line or "_bucket" in re.search(r"\], \[(.*?)\],", line).group(1), line
    assert shapes[0] == shapes[1] == shapes[2]


@pytest.mark.parametrize("name", ["lateral_sql", "lateral_sql_two_series", "lateral_sql_total_variation"])
def test_laterals_become_hash_joins(spark, name):
    text = plan(spark_entry.queries()[name](spark, SF))
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert text.count("Join [") == (2 if name == "lateral_sql_two_series" else 1)


def test_literal_arguments_of_functions_reach_the_scan(spark):
    text = plan(spark_entry.queries()["tvf_series"](spark, SF))
    assert "EqualTo(event_type,view)" in text and "GreaterThanOrEqual(ts,2024-01-01T00:00)" in text
    text = plan(spark_entry.queries()["tvf_named"](spark, SF))
    assert "GreaterThan(o_totalprice,20000.0)" in text and "LessThanOrEqual(o_totalprice,400000.5)" in text


def test_no_python_and_no_cartesian_products_anywhere(spark):
    for name in [name for module in MODULES for name in module.QUERIES]:
        text = plan(spark_entry.queries()[name](spark, SF))
        for part in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert part not in text, (name, part)


@pytest.mark.parametrize("name", ["tvf_series_detailed", "tvf_series_sql", "tvf_series_latest"])
def test_lists_of_ids_bound_the_scan(spark, name):
    text = plan(spark_entry.queries()[name](spark, SF))
    pushed = " ".join(re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", text))
    assert "GreaterThanOrEqual(event_type,click)" in pushed and "LessThanOrEqual(event_type,view)" in pushed


def test_many_ids_bound_the_scan(spark):
    ids = [("view", f"user_{i}") for i in range(3000)]
    text = plan(datapoints_detailed(points(spark, SF), ids, "0", "now"))
    assert "GreaterThanOrEqual(event_type,view)" in text and "Join" in text


def test_limits_per_series_rank_hours_only(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(spark_entry.queries()["per_series_limit"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    ranks = re.findall(r"Window \[row_number.*", text)
    assert ranks and all("hour" in line.split("],")[1] for line in ranks)
    joins = re.findall(r"(?:SortMerge|ShuffledHash)Join \[(.*?)\]", text)
    assert joins and all("hour" in keys for keys in joins)


def test_laterals_roll_up_only_the_series_wanted(spark):
    text = plan(spark_entry.queries()["lateral_two_series"](spark, SF))
    assert "LeftSemi" in text and text.count("partial_max") <= 2
