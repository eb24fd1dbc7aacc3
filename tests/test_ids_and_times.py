from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from viewloom.functions.identity import instance_id_array, instance_id_struct, parse_instance_id, parse_instance_ids
from viewloom.functions.timing import granularity_seconds, resolve_time, resolve_time_column

NOW = datetime(2024, 1, 31, tzinfo=timezone.utc)


def test_ids_split_at_the_first_colon():
    assert parse_instance_id("sailboat:ts1") == ("sailboat", "ts1")
    assert parse_instance_id("space:external:id:with:colons") == ("space", "external:id:with:colons")
    urn = "sailboat:vessels.urn:mrn:imo:mmsi:258219000::129038::navigation.speedOverGround"
    assert str(parse_instance_id(urn)) == urn


@pytest.mark.parametrize("text", ["", "no_colon", ":x", "x:", " : "])
def test_bad_ids(text):
    with pytest.raises(ValueError):
        parse_instance_id(text)


def test_id_lists():
    assert parse_instance_ids("sailboat:ts1 , otherspace:ts2") == [("sailboat", "ts1"), ("otherspace", "ts2")]
    assert parse_instance_ids([("s", "a,b"), "s:c", "s:c"]) == [("s", "a,b"), ("s", "c")]
    for text in ("", "  ,  ,  ", []):
        with pytest.raises(ValueError):
            parse_instance_ids(text)
    with pytest.raises(ValueError):
        parse_instance_ids("a:b,no_colon")


def test_id_columns(spark):
    df = spark.createDataFrame([("a:b:c",), ("nope",), (" a : b ",), ("a:",), (None,)], "t string")
    got = [r[0] and tuple(r[0]) for r in df.select(instance_id_struct(F.col("t"))).collect()]
    assert got == [("a", "b:c"), None, ("a", "b"), None, None]
    df = spark.createDataFrame([("a:b, ,c:d",)], "t string")
    assert [tuple(x) for x in df.select(instance_id_array(F.col("t"))).first()[0]] == [("a", "b"), ("c", "d")]
    with pytest.raises(Exception, match="instance id"):
        spark.createDataFrame([("a:b,x",)], "t string").select(instance_id_array(F.col("t"))).collect()


TIMES = [
    ("now", NOW),
    ("NOW", NOW),
    ("90s-ago", NOW - timedelta(seconds=90)),
    ("2w-ago", NOW - timedelta(weeks=2)),
    ("3d-ahead", NOW + timedelta(days=3)),
    ("2024-01-01T00:00:00Z", datetime(2024, 1, 1, tzinfo=timezone.utc)),
    ("2024-01-01T02:00:00+02:00", datetime(2024, 1, 1, tzinfo=timezone.utc)),
    ("2024-01-01 00:00:00.123456", datetime(2024, 1, 1, 0, 0, 0, 123000, tzinfo=timezone.utc)),
    ("2024-01-01T00:00:00.5Z", datetime(2024, 1, 1, 0, 0, 0, 500000, tzinfo=timezone.utc)),
    ("1704067200000", datetime(2024, 1, 1, tzinfo=timezone.utc)),
    ("0", datetime(1970, 1, 1, tzinfo=timezone.utc)),
]
NO_TIMES = ["2w-agoXYZ", "yesterday", "2024-13-01T00:00:00Z", "", "2 w-ago"]


def test_time_arguments():
    for text, expected in TIMES:
        assert resolve_time(text, NOW) == expected, text
    for text in NO_TIMES:
        with pytest.raises(ValueError):
            resolve_time(text, NOW)
    assert resolve_time(date(2024, 1, 1)) == resolve_time(1704067200000) == resolve_time(datetime(2024, 1, 1))
    with pytest.raises(TypeError):
        resolve_time(None, NOW)


def test_time_columns_agree_with_time_arguments(spark):
    texts = [t for t, _ in TIMES] + NO_TIMES
    now = F.lit("2024-01-31 00:00:00").cast("timestamp")
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select("i", F.unix_micros(resolve_time_column(F.col("t"), now))).orderBy("i").collect()
    expected = [int((m - datetime(1970, 1, 1, tzinfo=timezone.utc)) / timedelta(microseconds=1)) for _, m in TIMES]
    assert [r[1] for r in got] == expected + [None] * len(NO_TIMES)


def test_granularities():
    assert [granularity_seconds(g) for g in ("30s", "15m", "1h", "1d", "14d", "2W")] == [30, 900, 3600, 86400, 1209600,
                                                                                           1209600]
    for text in ("", "h", "0h", "1y", "1.5h", None):
        with pytest.raises(ValueError):
            granularity_seconds(text)
