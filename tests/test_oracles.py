"""Every registered query against its oracle SQL on the smallest given tables."""

import pytest

import __spark_entry__ as spark_entry
from oracle import connect, differences
from workload import MODULES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


@pytest.mark.parametrize("name", [name for module in MODULES for name in module.QUERIES])
def test_query(spark, connection, name):
    df = spark_entry.queries()[name](spark, SF)
    assert differences(df, connection, spark_entry.oracle_sql()[name]) == []


def test_entry(spark):
    assert spark_entry.entry(spark).columns == ["class_", "count_externalId", "min_totalPrice", "max_totalPrice"]
    assert spark_entry.entry(spark).count() > 0
