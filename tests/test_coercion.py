from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewloom.functions.coercion import coerce, coerce_columns, relation_id

TS, D = datetime(2024, 1, 1, 10), date(2024, 1, 1)
CASES = {
    T.LongType(): {
        "5": 5, '"5"': 5, '" 7 "': 7, "5.7": 5, "-5.7": -5, '"5.7"': None, '"abc"': None, "true": 1, "null": None,
        "[1]": None, '{"a": 1}': None, '{"externalId": "12"}': 12,
    },
    T.DoubleType(): {
        "5": 5.0, '"5.7"': 5.7, '" 1e3 "': 1000.0, '"abc"': None, '"1.5d"': None, "false": 0.0, "null": None,
        '"-.5"': -0.5,
    },
    T.BooleanType(): {
        "true": True, "false": False, '" TRUE "': True, '"1"': True, '"Yes"': True, '"2"': False, '"no"': False,
        "2": True, "0": False, "0.0": False, "null": None, "[]": False, "[0]": True, "{}": False,
    },
    T.TimestampType(): {
        "1704103200000": TS, "0": datetime(1970, 1, 1), '"2024-01-01T10:00:00Z"': TS, '"2024-01-01T10:00"': TS,
        '"2024-01-01T12:00:00+02:00"': TS, '"2024-01-01 10:00:00"': TS, '" "': None, '"1704103200000"': None,
        '"soon"': None, "null": None, '"2024-01-01T10:00:00.250Z"': datetime(2024, 1, 1, 10, 0, 0, 250000),
        '"2024-02-30T10:00:00Z"': None,
    },
    T.DateType(): {
        "1704103200000": D, '"2024-01-01"': D, '"2024-01-01T23:00:00-05:00"': D, '"2024-01-01T10:00:00Z"': D,
        '"2024-01-01 10:00:00"': None, '"x"': None, "-1": date(1969, 12, 31), "null": None,
    },
    T.StringType(): {
        '"x"': "x", "5": "5", "true": "true", '{"space": "s", "externalId": "e"}': "e", '{"external_id": "e"}': "e",
        '"{space=s, externalId=e }"': "e", '["é", 1]': '["é", 1]', '[{"externalId": "a"}, "b"]': '["a", "b"]',
        '"[bad"': "[bad", "null": None, '"{other=1}"': "{other=1}", '{"k": "é"}': '{"k":"é"}',
        '["{space=s, externalId=q\\"x}"]': '["q\\"x"]',
        '[{"externalId": "q\\"x"}, {"external_id": "y"}]': '["q\\"x", "y"]',
        '[{"externalId": "a"}, {"external_id": "b"}]': '["a", "b"]', '[{"externalId": "a"}, {"k": 1}]': '["a", {"k":1}]',
        '["externalId"]': '["externalId"]',
    },
    T.ArrayType(T.StringType()): {
        '["a", "b"]': ["a", "b"], '"[\\"a\\"]"': ["a"], '"[\\"[\\\\\\"a\\\\\\"]\\"]"': ["a"], '"a"': None, "[]": [],
        '[{"externalId": "a"}, null, 1]': ["a", None, "1"], '[{"externalId": "a"}, {"external_id": "b"}]': ["a", "b"], "5": None, "null": None,
    },
    T.ArrayType(T.LongType()): {"[1, 2.5]": [1, 2], '["1", "x"]': [1, None], '"[1, 2]"': [1, 2]},
    T.ArrayType(T.TimestampType()): {'[1704103200000, "2024-01-01T10:00:00Z", null]': [TS, TS, None]},
    T.ArrayType(T.DateType()): {'["2024-01-01", 1704103200000]': [D, D]},
    T.ArrayType(T.BooleanType()): {'[true, "yes", "x", 0]': [True, True, False, False]},
}


@pytest.mark.parametrize("data_type", list(CASES), ids=lambda t: t.simpleString())
def test_coercion(spark, data_type):
    cases = CASES[data_type]
    df = spark.createDataFrame([(j,) for j in cases], "j string").select("j", F.parse_json("j").alias("v"))
    alone = {r[0]: r[1] for r in df.select("j", coerce(F.col("v"), data_type)).collect()}
    staged = {r[0]: r[1] for r in coerce_columns(df, {"c": (F.col("v"), data_type)}, ("j",)).collect()}
    assert alone == cases
    assert staged == cases


def test_sql_null_stays_null(spark):
    df = spark.sql("SELECT CAST(NULL AS VARIANT) AS v")
    assert all(df.select(coerce(F.col("v"), t)).first()[0] is None for t in CASES)
    assert df.select(relation_id(F.col("v"))).first()[0] is None


def test_session_time_zone_does_not_matter(spark):
    df = spark.sql("SELECT parse_json('\"2024-01-01T10:00:00\"') AS v")
    query = df.select(F.unix_micros(coerce(F.col("v"), T.TimestampType())), coerce(F.col("v"), T.DateType()))
    expected = (1704103200000000, D)
    assert tuple(query.first()) == expected
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert tuple(query.first()) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
