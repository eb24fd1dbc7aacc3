"""Queries in SQL over registered views and table functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from viewloom.plans.sql_surface import create_series_functions, create_view, create_view_function
from workload.series import GRID_END, GRID_SQL, GRID_START, IDS_SQL, IN_RANGE, bucket_sql, variance_sql
from workload.tables import ORDER_VIEW, ORDERS_SQL, PART_VIEW, PARTS_SQL, POINTS_SQL, USERS_SQL
from workload.tables import orders, parts, points, users

QUERIES = {}
ORACLES = {}

RANGE = "'2024-01-01T00:00:00Z', '2024-01-31 00:00:00'"
IDS = "'view:user_1, click:user_2,,error:user_3'"
NULL_TIMES = """CAST(NULL AS TIMESTAMP) AS "createdTime", CAST(NULL AS TIMESTAMP) AS "lastUpdatedTime",
    CAST(NULL AS TIMESTAMP) AS "deletedTime\""""


def _register(name: str, tables: tuple, sql: str, oracle: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        for table, kind in tables:
            table(spark, sf_dir).createOrReplaceTempView(f"{table.__name__}_table")
            if kind == "points":
                create_series_functions(spark, "points_table")
            elif kind is not None:
                create_view(spark, kind, f"{table.__name__}_table")
                create_view_function(spark, kind, f"{table.__name__}_table")
        return spark.sql(sql)

    run.__name__ = name
    QUERIES[name], ORACLES[name] = run, oracle


ORDER_TABLE = ((orders, ORDER_VIEW),)
PART_TABLE = ((parts, PART_VIEW),)
POINT_TABLE = ((points, "points"),)
USERS_AND_POINTS = ((users, None), (points, "points"))

_register("sql_view", ORDER_TABLE, "SELECT * FROM OrderView", f"SELECT * FROM {ORDERS_SQL}")
_register(
    "sql_where",
    ORDER_TABLE,
    """SELECT external_id, class_, totalPrice FROM OrderView WHERE space = 'O' AND orderDate > '1997-01-01'
    AND shipNote IS NOT NULL AND clerk IS NOT NULL AND totalPrice > 50000 AND totalPrice < 300000""",
    f"""SELECT external_id, class_, "totalPrice" FROM {ORDERS_SQL} WHERE space = 'O'
    AND "orderDate" > TIMESTAMP '1997-01-01 00:00:00' AND "shipNote" IS NOT NULL AND clerk IS NOT NULL
    AND "totalPrice" > 50000 AND "totalPrice" < 300000""",
)
_register(
    "sql_count_group_by",
    ORDER_TABLE,
    """SELECT space, class_, COUNT(*) AS total_rows, COUNT(shipNote) AS with_note, COUNT(clerk) AS with_clerk
    FROM OrderView GROUP BY space, class_""",
    f"""SELECT space, class_, COUNT(*) AS total_rows, COUNT("shipNote") AS with_note, COUNT(clerk) AS with_clerk
    FROM {ORDERS_SQL} GROUP BY space, class_""",
)
_register(
    "tvf_positional",
    ORDER_TABLE,
    "SELECT * FROM order_view_udtf('F', NULL, NULL, '2-HIGH')",
    f"SELECT * FROM {ORDERS_SQL} WHERE status = 'F' AND class_ = '2-HIGH'",
)
_register(
    "tvf_named",
    ORDER_TABLE,
    """SELECT external_id, clerk, totalPrice FROM order_view_udtf(
      clerk => '[3, 5, 8]', instance_space => '["O", "P"]', _exists => '["shipNote"]', _not_exists => NULL,
      _gt => '{"totalPrice": 20000}', _gte => '{"orderDate": "1996-01-01T00:00:00Z"}',
      _lte => '{"totalPrice": 400000.5}')""",
    f"""SELECT external_id, clerk, "totalPrice" FROM {ORDERS_SQL} WHERE clerk IN (3, 5, 8) AND space IN ('O', 'P')
    AND "shipNote" IS NOT NULL AND "totalPrice" > 20000 AND "totalPrice" <= 400000.5
    AND "orderDate" >= TIMESTAMP '1996-01-01 00:00:00'""",
)
_register(
    "tvf_contains_any",
    PART_TABLE,
    """SELECT external_id, array_join(tags, ' ') AS tags
    FROM part_view_udtf(tags => '["red", "blue"]', _lt => '{"size": 20}')""",
    f"""SELECT external_id, array_to_string(tags, ' ') AS tags FROM {PARTS_SQL}
    WHERE list_has_any(tags, ['red', 'blue']) AND size < 20""",
)
_register(  # any rows may come, so they are counted: no row twice, and all of them rows of the view
    "tvf_row_limit",
    ORDER_TABLE,
    """SELECT 40 AS limit, count(*) AS total_rows, count(DISTINCT l.space, l.external_id) AS instances, count(o.external_id) AS known
      FROM order_view_udtf(_row_limit => 40) l LEFT JOIN OrderView o ON o.space = l.space AND o.external_id = l.external_id
    UNION ALL SELECT 5000, count(*), count(DISTINCT l.space, l.external_id), count(o.external_id)
      FROM order_view_udtf(_row_limit => 5000) l LEFT JOIN OrderView o ON o.space = l.space AND o.external_id = l.external_id""",
    f"""SELECT n AS limit, least(n, t) AS total_rows, least(n, t) AS instances, least(n, t) AS known
    FROM (SELECT unnest([40, 5000]) AS n, (SELECT count(*) FROM {ORDERS_SQL}) AS t)""",
)
_register(
    "tvf_list_like_text",
    ORDER_TABLE,
    """SELECT 'broken' AS kind, external_id FROM order_view_udtf('[F', _gt => '{"totalPrice": 1}')
    UNION ALL SELECT 'unquoted', external_id FROM order_view_udtf('[F]')
    UNION ALL SELECT 'list', external_id FROM order_view_udtf(' ["F"]', _gt => '{"totalPrice": 400000}')""",
    f"""SELECT 'list' AS kind, external_id FROM {ORDERS_SQL} WHERE status = 'F' AND "totalPrice" > 400000
    UNION ALL SELECT 'unquoted', external_id FROM {ORDERS_SQL} WHERE status = '[F]'
    UNION ALL SELECT 'broken', external_id FROM {ORDERS_SQL} WHERE status = '[F'""",
)
_register(
    "tvf_fraction_bound",
    ORDER_TABLE,
    """SELECT clerk, count(*) AS total_rows FROM order_view_udtf(_gt => '{"clerk": 2.5}', _lte => '{"clerk": 6.5}') GROUP BY clerk
    UNION ALL SELECT -1, count(*) FROM order_view_udtf(clerk => '4.5')
    UNION ALL SELECT -2, count(*) FROM order_view_udtf(clerk => '[4.5, 7]')""",
    f"""SELECT clerk, count(*) AS total_rows FROM {ORDERS_SQL} WHERE clerk > 2.5 AND clerk <= 6.5 GROUP BY clerk
    UNION ALL SELECT -1, 0 UNION ALL SELECT -2, count(*) FROM {ORDERS_SQL} WHERE clerk = 7""",
)
_register(
    "tvf_aggregate",
    ORDER_TABLE,
    """SELECT * FROM order_view_udtf(instance_space => 'O', _query_mode => 'aggregate', _aggregates =>
    '[{"fn": "count", "property": "externalId"}, {"fn": "max", "property": "totalPrice"},
      {"fn": "min", "property": "clerk"}]')""",
    f"""SELECT CAST(NULL AS VARCHAR) AS status, max("totalPrice") AS "totalPrice",
    CAST(NULL AS TIMESTAMP) AS "orderDate", CAST(NULL AS VARCHAR) AS class_, CAST(NULL AS VARCHAR) AS customer,
    CAST(NULL AS VARCHAR) AS "shipNote", min(clerk) AS clerk, CAST(NULL AS VARCHAR) AS space,
    CAST(count(*) AS VARCHAR) AS external_id, {NULL_TIMES} FROM {ORDERS_SQL} WHERE space = 'O'""",
)
_register(
    "tvf_aggregate_grouped",
    ORDER_TABLE,
    """SELECT class_, space, external_id, totalPrice FROM order_view_udtf(_query_mode => 'aggregate', _aggregates =>
    '[{"fn": "count", "property": "externalId"}, {"fn": "min", "property": "totalPrice"}]',
    _group_by => '["class", "space"]')""",
    f"""SELECT class_, space, CAST(count(*) AS VARCHAR) AS external_id, min("totalPrice") AS "totalPrice"
    FROM {ORDERS_SQL} GROUP BY class_, space""",
)
_register(
    "tvf_aggregate_grouped_many",
    ORDER_TABLE,
    """SELECT customer, external_id, totalPrice FROM order_view_udtf(_query_mode => 'aggregate', _aggregates =>
    '[{"fn": "count", "property": "externalId"}, {"fn": "max", "property": "totalPrice"}]', _group_by => '["customer"]')""",
    f"""SELECT customer, CAST(count(*) AS VARCHAR) AS external_id, max("totalPrice") AS "totalPrice"
    FROM {ORDERS_SQL} GROUP BY customer""",
)
_register(
    "tvf_series",
    POINT_TABLE,
    f"SELECT * FROM time_series_datapoints_udtf('view:user_1', {RANGE})",
    f"""SELECT ts AS timestamp, value FROM {POINTS_SQL} WHERE {IN_RANGE} AND space = 'view'
    AND external_id = 'user_1'""",
)
_register(
    "tvf_series_detailed",
    POINT_TABLE,
    f"SELECT * FROM time_series_datapoints_detailed_udtf({IDS}, {RANGE})",
    f"""SELECT ts AS timestamp, value, status_code, status_symbol, external_id, space FROM {POINTS_SQL}
    WHERE {IN_RANGE} AND {IDS_SQL}""",
)
_register(
    "tvf_series_sql",
    POINT_TABLE,
    f"""SELECT timestamp, round(value, 6) AS value, external_id, space
    FROM time_series_sql_udtf({IDS}, {RANGE}, 'avg', '1d')""",
    f"""SELECT {bucket_sql(86400)} AS timestamp, round(avg(value), 6) AS value, external_id, space
    FROM {POINTS_SQL} WHERE {IN_RANGE} AND {IDS_SQL} GROUP BY 1, external_id, space""",
)
_register(
    "tvf_series_interpolation",
    POINT_TABLE,
    f"""SELECT timestamp, round(value, 6) AS value, external_id, space FROM time_series_datapoints_detailed_udtf(
      {IDS}, '{GRID_START}', '{GRID_END}', 'interpolation', '6h')""",
    f"WITH {GRID_SQL} SELECT timestamp, value, external_id, space FROM lines WHERE value IS NOT NULL AND {IDS_SQL}",
)
_register(
    "tvf_series_variance",
    POINT_TABLE,
    f"""SELECT timestamp, round(value, 4) AS value, external_id, space FROM time_series_datapoints_detailed_udtf(
      {IDS}, {RANGE}, 'continuousVariance', '2w')""",
    f"SELECT timestamp, value, external_id, space FROM ({variance_sql('value')}) WHERE {IDS_SQL}",
)
_register(
    "tvf_series_latest",
    POINT_TABLE,
    f"""SELECT * FROM time_series_latest_datapoints_udtf(instance_ids => {IDS}, before => '2024-01-31 00:00:00',
    include_status => true)""",
    f"""SELECT space || ':' || external_id AS time_series_external_id, max(ts) AS timestamp,
    arg_max(value, ts) AS value, arg_max(status_code, ts) AS status_code FROM {POINTS_SQL}
    WHERE ts < TIMESTAMP '2024-01-31 00:00:00' AND {IDS_SQL} GROUP BY space, external_id""",
)
_register(
    "lateral_sql",
    USERS_AND_POINTS,
    f"""SELECT v.external_id AS user_id, v.name, ts.timestamp, ts.value FROM users_table v
    CROSS JOIN LATERAL (SELECT * FROM time_series_datapoints_udtf(
      CONCAT(v.viewSeriesSpace, ':', v.viewSeries), {RANGE})) ts WHERE v.viewSeries IS NOT NULL""",
    f"""SELECT u.external_id AS user_id, u.name, p.ts AS timestamp, p.value FROM {USERS_SQL} u
    JOIN {POINTS_SQL} p ON p.space = u.view_space AND p.external_id = u.view_id WHERE {IN_RANGE}""",
)
_register(
    "lateral_sql_two_series",
    USERS_AND_POINTS,
    f"""SELECT u.external_id AS user_id, v.timestamp, v.value AS views, c.value AS clicks FROM users_table u
    CROSS JOIN LATERAL (SELECT * FROM time_series_datapoints_udtf(
      CONCAT(u.viewSeriesSpace, ':', u.viewSeries), {RANGE}, 'max', '1d')) v
    CROSS JOIN LATERAL (SELECT * FROM time_series_datapoints_udtf(u.clickSeries, {RANGE}, 'max', '1d')) c
    WHERE u.viewSeries IS NOT NULL AND u.clickSeries IS NOT NULL AND c.timestamp = v.timestamp""",
    f"""WITH d AS (SELECT space, external_id, {bucket_sql(86400)} AS day, max(value) AS value
      FROM {POINTS_SQL} WHERE {IN_RANGE} GROUP BY space, external_id, 3)
    SELECT u.external_id AS user_id, v.day AS timestamp, v.value AS views, c.value AS clicks FROM {USERS_SQL} u
    JOIN d v ON v.space = u.view_space AND v.external_id = u.view_id
    JOIN d c ON c.space = u.click_space AND c.external_id = u.click_id AND c.day = v.day""",
)
_register(
    "lateral_sql_total_variation",
    USERS_AND_POINTS,
    f"""SELECT u.external_id AS user_id, ts.timestamp, round(ts.value, 6) AS value FROM users_table u
    CROSS JOIN LATERAL (SELECT * FROM time_series_datapoints_udtf(u.clickSeries, {RANGE}, 'totalVariation', '1w')) ts
    WHERE u.clickSeries IS NOT NULL""",
    f"""WITH s AS (SELECT space, external_id, {bucket_sql(604800)} AS bucket, value,
      lag(value) OVER (PARTITION BY space, external_id, {bucket_sql(604800)} ORDER BY ts) AS before
      FROM {POINTS_SQL} WHERE {IN_RANGE}),
    d AS (SELECT space, external_id, bucket, round(coalesce(sum(abs(value - before)), 0.0), 6) AS value
      FROM s GROUP BY space, external_id, bucket)
    SELECT u.external_id AS user_id, d.bucket AS timestamp, d.value FROM {USERS_SQL} u
    JOIN d ON d.space = u.click_space AND d.external_id = u.click_id""",
)
