"""Queries over the datapoint table: raw, rolled-up and latest points, and views joined with their series."""

from __future__ import annotations

from pyspark.sql import functions as F

from viewloom.operators.datapoints import (
    datapoints,
    datapoints_detailed,
    datapoints_of,
    latest_datapoints,
    latest_of_space,
    limit_per_series,
    series_aggregate,
)
from viewloom.operators.joins import referred_series, with_series
from viewloom.operators.rollups import bucket_counts
from workload.registry import registrar
from workload.tables import END, NOW, POINTS_SQL, START, USERS_SQL, points, users

QUERIES = {}
ORACLES = {}

IN_RANGE = "ts >= TIMESTAMP '2024-01-01 00:00:00' AND ts < TIMESTAMP '2024-01-31 00:00:00'"
IDS = "view:user_1, click:user_2,error:user_3, nowhere:user_1 ,"
IDS_SQL = "((space = 'view' AND external_id = 'user_1') OR (space = 'click' AND external_id = 'user_2') " \
    "OR (space = 'error' AND external_id = 'user_3'))"


query = registrar(QUERIES, ORACLES)


def bucket_sql(seconds: int, column: str = "ts") -> str:
    micros = seconds * 1_000_000
    return f"make_timestamp(epoch_us({column}) // {micros} * {micros})"


@query(f"""SELECT ts AS timestamp, value FROM {POINTS_SQL} WHERE {IN_RANGE} AND space = 'view'
    AND external_id = 'user_1'""")
def datapoints_raw(spark, sf_dir):
    return datapoints_of(points(spark, sf_dir), "view", "user_1", START, END, now=NOW)


@query(f"""SELECT ts AS timestamp, value, status_code FROM {POINTS_SQL} WHERE space = 'purchase'
    AND external_id = 'user_5' AND ts >= TIMESTAMP '2024-01-10 06:00:00' AND ts < TIMESTAMP '2024-01-24 00:00:00'
    UNION ALL SELECT ts, value, NULL FROM {POINTS_SQL} WHERE space = 'signup' AND external_id = 'user_7'
    AND ts >= TIMESTAMP '2024-01-17 00:00:00' AND ts < TIMESTAMP '2024-01-31 00:00:00'""")
def datapoints_range(spark, sf_dir):
    table = points(spark, sf_dir)
    bounded = datapoints_detailed(table, "purchase:user_5", "2024-01-10T06:00:00Z", "1w-ago", now=NOW)
    default = datapoints(table, "signup:user_7", now=NOW)
    return bounded.select("timestamp", "value", "status_code").unionByName(default, allowMissingColumns=True)


@query(f"""SELECT ts AS timestamp, value, CAST(NULL AS VARCHAR) AS value_string, status_code, status_symbol,
    external_id, space FROM {POINTS_SQL} WHERE {IN_RANGE} AND {IDS_SQL}""")
def datapoints_detailed_some(spark, sf_dir):
    return datapoints_detailed(points(spark, sf_dir), IDS, START, END, now=NOW)


@query(f"""SELECT ts AS timestamp, value, CAST(NULL AS VARCHAR) AS value_string, status_code, status_symbol,
    external_id, space FROM {POINTS_SQL} WHERE {IN_RANGE}""", "datapoints_detailed")
def all_datapoints_detailed(spark, sf_dir):
    return datapoints_detailed(points(spark, sf_dir), None, START, END, now=NOW)


@query(f"""SELECT {bucket_sql(86400)} AS timestamp, round(avg(value), 6) AS value, external_id, space
    FROM {POINTS_SQL} WHERE {IN_RANGE} GROUP BY 1, external_id, space""")
def series_sql_aggregate(spark, sf_dir):
    rows = series_aggregate(points(spark, sf_dir), None, START, END, " AVG ", "1d", now=NOW)
    return rows.withColumn("value", F.round("value", 6))


# Latest points


@query(f"""SELECT space || ':' || external_id AS time_series_external_id, max(ts) AS timestamp,
    arg_max(value, ts) AS value, CAST(NULL AS INTEGER) AS status_code FROM {POINTS_SQL}
    WHERE ts < TIMESTAMP '2024-01-31 00:00:00' GROUP BY space, external_id""")
def latest_datapoint(spark, sf_dir):
    return latest_datapoints(points(spark, sf_dir), None, now=NOW)


@query(f"""SELECT space || ':' || external_id AS time_series_external_id, max(ts) AS timestamp,
    arg_max(value, ts) AS value, CAST(NULL AS INTEGER) AS status_code FROM {POINTS_SQL}
    WHERE ts < TIMESTAMP '2024-01-03 12:00:00' GROUP BY space, external_id""")
def latest_before(spark, sf_dir):
    return latest_datapoints(points(spark, sf_dir), None, before="2024-01-03 12:00:00", now=NOW)


@query(f"""SELECT space || ':' || external_id AS time_series_external_id, max(ts) AS timestamp,
    arg_max(value, ts) AS value, arg_max(status_code, ts) AS status_code FROM {POINTS_SQL}
    WHERE ts < TIMESTAMP '2024-01-30 00:00:00' GROUP BY space, external_id""")
def latest_with_status(spark, sf_dir):
    return latest_datapoints(points(spark, sf_dir), None, before="1d-ago", include_status=True, now=NOW)


@query(f"""SELECT external_id AS time_series_external_id, max(ts) AS timestamp, arg_max(value, ts) AS value,
    arg_max(status_code, ts) AS status_code FROM {POINTS_SQL}
    WHERE space = 'click' AND ts < TIMESTAMP '2024-01-31 00:00:00' GROUP BY external_id""")
def latest_one_space(spark, sf_dir):
    return latest_of_space(points(spark, sf_dir), "click", None, include_status=True, now=NOW)


# Rollups

GRANULARITIES = {"30s": 30, "15m": 900, "1h": 3600, "1d": 86400, "2w": 1209600, "30d": 2592000}


@query(
    " UNION ALL ".join(
        f"SELECT '{g}' AS granularity, {bucket_sql(w)} AS timestamp, count(*) AS points FROM events GROUP BY 2"
        for g, w in GRANULARITIES.items()
    )
)
def bucket_granularities(spark, sf_dir):
    return bucket_counts(points(spark, sf_dir), list(GRANULARITIES))


def _register_plain(name: str, aggregate: str, sql: str, granularity: str, seconds: int) -> None:
    def run(spark, sf_dir):
        rows = datapoints_detailed(points(spark, sf_dir), None, START, END, aggregate, granularity, NOW)
        return rows.select("space", "external_id", "timestamp", F.round("value", 6).alias("value"))

    run.__name__ = name
    query(
        f"""SELECT space, external_id, {bucket_sql(seconds)} AS timestamp, round({sql}, 6) AS value
        FROM {POINTS_SQL} WHERE {IN_RANGE} GROUP BY space, external_id, 3"""
    )(run)


_register_plain("series_average", "average", "avg(value)", "1d", 86400)
_register_plain("series_max", "Max", "max(value)", "12h", 43200)
_register_plain("series_min", "min", "min(value)", "6h", 21600)
_register_plain("series_count", "count", "CAST(count(value) AS DOUBLE)", "2d", 172800)
_register_plain("series_sum", "sum", "sum(value)", "1w", 604800)
_register_plain("series_discrete_variance", "discreteVariance", "var_pop(value)", "14d", 1209600)


@query(f"""WITH s AS (SELECT space, external_id, {bucket_sql(604800)} AS bucket, value,
      lag(value) OVER (PARTITION BY space, external_id, {bucket_sql(604800)} ORDER BY ts) AS before
      FROM {POINTS_SQL} WHERE {IN_RANGE})
    SELECT space, external_id, bucket AS timestamp, round(coalesce(sum(abs(value - before)), 0.0), 6) AS value
    FROM s GROUP BY space, external_id, bucket""")
def series_total_variation(spark, sf_dir):
    rows = datapoints_detailed(points(spark, sf_dir), None, START, END, "totalVariation", "1w", NOW)
    return rows.select("space", "external_id", "timestamp", F.round("value", 6).alias("value"))


def variance_sql(value: str) -> str:
    """Variance of the line through a bucket's points, with values taken from the bucket's mean of points first."""
    return f"""WITH c AS (SELECT space, external_id, {bucket_sql(1209600)} AS bucket, ts,
      {value} - avg({value}) OVER (PARTITION BY space, external_id, {bucket_sql(1209600)}) AS v FROM {POINTS_SQL} WHERE {IN_RANGE}),
    s AS (SELECT space, external_id, bucket, v AS b, lag(v) OVER w AS a,
      (epoch_us(ts) - lag(epoch_us(ts)) OVER w) / 1000000.0 AS dt FROM c WINDOW w AS (PARTITION BY space, external_id, bucket ORDER BY ts)),
    t AS (SELECT space, external_id, bucket, sum((a + b) / 2 * dt) / sum(dt) AS mean,
      sum((a * a + a * b + b * b) / 3 * dt) / sum(dt) AS square FROM s GROUP BY space, external_id, bucket)
    SELECT space, external_id, bucket AS timestamp, CASE WHEN mean IS NOT NULL
      THEN round(square - mean * mean, 4) END AS value FROM t"""


@query(variance_sql("value"))
def series_continuous_variance(spark, sf_dir):
    rows = datapoints_detailed(points(spark, sf_dir), None, START, END, "continuousVariance", "2w", NOW)
    return rows.select("space", "external_id", "timestamp", F.round("value", 4).alias("value"))


@query(variance_sql("(value + 1e9)"))
def series_continuous_variance_offset(spark, sf_dir):
    far = points(spark, sf_dir).withColumn("value", F.col("value") + 1e9)
    rows = datapoints_detailed(far, None, START, END, "continuousVariance", "2w", NOW)
    return rows.select("space", "external_id", "timestamp", F.round("value", 4).alias("value"))


# The range starts and ends amid the data: points before and after it count as neighbours.
GRID_START, GRID_END = "2024-01-10T00:00:00Z", "2024-01-21 00:00:00"
GRID_SQL = f"""p AS (SELECT * FROM {POINTS_SQL} WHERE value IS NOT NULL),
    g AS (SELECT s.space, s.external_id, b.b FROM (SELECT DISTINCT space, external_id FROM p) s
      CROSS JOIN (SELECT unnest(generate_series(TIMESTAMP '2024-01-10 00:00:00', TIMESTAMP '2024-01-20 18:00:00',
        INTERVAL 6 HOUR)) AS b) b),
    g0 AS (SELECT g.space, g.external_id, g.b, p.ts AS t0, p.value AS v0 FROM g ASOF LEFT JOIN p
      ON g.space = p.space AND g.external_id = p.external_id AND g.b >= p.ts),
    g1 AS (SELECT g0.*, p.ts AS t1, p.value AS v1 FROM g0 ASOF LEFT JOIN p
      ON g0.space = p.space AND g0.external_id = p.external_id AND g0.b <= p.ts),
    lines AS (SELECT space, external_id, b AS timestamp, round(CASE WHEN t0 = b THEN v0 ELSE v0 + (v1 - v0)
      * ((epoch_us(b) - epoch_us(t0)) / (epoch_us(t1) - epoch_us(t0))) END, 6) AS value FROM g1)"""


@query(f"WITH {GRID_SQL} SELECT * FROM lines WHERE value IS NOT NULL")
def series_interpolation(spark, sf_dir):
    rows = datapoints_detailed(points(spark, sf_dir), None, GRID_START, GRID_END, "interpolation", "6h", NOW)
    return rows.select("space", "external_id", "timestamp", F.round("value", 6).alias("value"))


@query(f"WITH {GRID_SQL} SELECT space, external_id, b AS timestamp, v0 AS value FROM g0 WHERE v0 IS NOT NULL")
def series_step_interpolation(spark, sf_dir):
    rows = datapoints_detailed(points(spark, sf_dir), None, GRID_START, GRID_END, "stepInterpolation", "6h", NOW)
    return rows.select("space", "external_id", "timestamp", "value")


@query(f"""SELECT space, external_id, timestamp, value FROM (SELECT space, external_id, ts AS timestamp, value,
    row_number() OVER (PARTITION BY space, external_id ORDER BY ts) AS rn FROM {POINTS_SQL} WHERE {IN_RANGE})
    WHERE rn <= 5""")
def per_series_limit(spark, sf_dir):
    rows = datapoints_detailed(points(spark, sf_dir), None, START, END, now=NOW)
    return limit_per_series(rows.select("space", "external_id", "timestamp", "value"), 5)


SHARED_TOTAL = 8  # over four ids: two rows each, so that it binds


@query(f"""SELECT timestamp, value, external_id, space FROM (SELECT *, row_number() OVER
      (PARTITION BY space, external_id ORDER BY timestamp) AS rn FROM
      (SELECT {bucket_sql(3600)} AS timestamp, max(value) AS value, external_id, space FROM {POINTS_SQL}
       WHERE {IN_RANGE} AND {IDS_SQL} GROUP BY 1, external_id, space)) WHERE rn <= {SHARED_TOTAL // 4}""")
def shared_total_limit(spark, sf_dir):
    return series_aggregate(points(spark, sf_dir), IDS, START, END, "max", "1h", now=NOW, total_limit=SHARED_TOTAL)


# Views with their series


@query(f"""SELECT u.external_id AS user_id, u.name, p.ts AS timestamp, p.value FROM {USERS_SQL} u
    JOIN {POINTS_SQL} p ON p.space = u.click_space AND p.external_id = u.click_id WHERE {IN_RANGE}""")
def lateral_datapoints(spark, sf_dir):
    series = datapoints_detailed(points(spark, sf_dir), None, START, END, now=NOW)
    rows = users(spark, sf_dir).select(F.col("external_id").alias("user_id"), "name", "clickSeries")
    joined = with_series(rows, series, {"timestamp": "timestamp", "value": "value"}, instance_id="clickSeries")
    return joined.drop("clickSeries")


@query(f"""WITH d AS (SELECT space, external_id, {bucket_sql(86400)} AS day, max(value) AS value
      FROM {POINTS_SQL} WHERE {IN_RANGE} GROUP BY space, external_id, 3)
    SELECT u.external_id AS user_id, v.day AS timestamp, v.value AS views, c.value AS clicks FROM {USERS_SQL} u
    JOIN d v ON v.space = u.view_space AND v.external_id = u.view_id
    JOIN d c ON c.space = u.click_space AND c.external_id = u.click_id AND c.day = v.day""")
def lateral_two_series(spark, sf_dir):
    rows = users(spark, sf_dir).select(
        F.col("external_id").alias("user_id"), "viewSeriesSpace", "viewSeries", "clickSeries"
    ).where("viewSeries IS NOT NULL AND clickSeries IS NOT NULL")
    named = referred_series(rows, [{"space": "viewSeriesSpace", "external_id": "viewSeries"}, {"instance_id": "clickSeries"}])
    wanted = points(spark, sf_dir).join(named, ["space", "external_id"], "left_semi")
    daily = datapoints_detailed(wanted, None, START, END, "max", "1d", NOW)
    one = with_series(
        rows,
        daily,
        {"timestamp": "timestamp", "value": "views"},
        space="viewSeriesSpace",
        external_id="viewSeries",
    )
    both = with_series(
        one, daily, {"value": "clicks"}, instance_id="clickSeries", aligned=("timestamp", "timestamp")
    )
    return both.select("user_id", "timestamp", "views", "clicks")
