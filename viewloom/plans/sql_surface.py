"""SQL views and table functions over registered tables.

The functions are Spark SQL functions, not Python ones: Spark inlines their bodies into the calling query, so with
literal arguments the unused branches fold away, conditions reach the file scan and unused columns are pruned.

Each ``create_*`` needs the name of a table or temporary view with the data, and registers for the session. The
``*_ddl`` functions return the statement, for a catalog or for inspection.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from viewloom.functions.timing import ISO, RELATIVE, UNIT_SECONDS
from viewloom.model import IDENTITY_COLUMNS, LIFECYCLE_COLUMNS, Property, ViewDef, function_name_for
from viewloom.operators.aggregates import MAX_METRICS
from viewloom.operators.rollups import (
    AGGREGATES,
    GRID_BUCKETS,
    GRIDDED,
    ORDERED,
    ORDERED_RESULTS,
    PLAIN,
    PLAIN_SQL,
    SQL_AGGREGATES,
    STRETCH,
    bucket_sums,
    ordered_sums,
)

# The parameters that follow the property parameters of every view function, in order.
PUSHDOWN_PARAMETERS = {
    "instance_space": "STRING",
    "external_id": "STRING",
    "_exists": "STRING",
    "_not_exists": "STRING",
    "_gt": "STRING",
    "_gte": "STRING",
    "_lt": "STRING",
    "_lte": "STRING",
    "_row_limit": "BIGINT",
    "_query_mode": "STRING",
    "_aggregates": "STRING",
    "_group_by": "STRING",
}
COMPARISONS = {"_gt": ">", "_gte": ">=", "_lt": "<", "_lte": "<="}
METRICS_TYPE = "array<struct<fn: string, property: string>>"
# What integers are compared as where a fraction may turn up.
EXACT = "decimal(38,9)"
# Row limits are met by hash buckets of the instances: whole ones as far as they fit, and part of one more.
LIMIT_BUCKETS = 16384


def _name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _qualified(name: str) -> str:
    """A name of one or more parts, each quoted unless it is already."""
    return name if "`" in name else ".".join(_name(part) for part in name.split("."))


def view_ddl(view: ViewDef, source: str, name: str | None = None, temporary: bool = True) -> str:
    """A SQL view with the view's columns, unfiltered; conditions above it are pushed down by Spark."""
    columns = ", ".join(_name(c) for c in view.columns)
    kind = "TEMPORARY VIEW" if temporary else "VIEW"
    return f"CREATE OR REPLACE {kind} {_qualified(name or view.external_id)} AS SELECT {columns} FROM {source}"


def create_view(spark: SparkSession, view: ViewDef, source: str, name: str | None = None) -> None:
    spark.sql(view_ddl(view, source, name))


def create_views(spark: SparkSession, model: dict[str, ViewDef]) -> None:
    """One SQL view per view of a model, given as source table name -> view."""
    for source, view in model.items():
        create_view(spark, view, source)


class _ViewFunction:
    """The statement of one view function, piece by piece. Parameters are qualified: columns share their names."""

    def __init__(self, view: ViewDef, source: str, name: str) -> None:
        self.view, self.source, self.name = view, source, name

    def parameter(self, name: str) -> str:
        return f"{_name(self.name.split('.')[-1])}.{_name(name)}"

    def list_in(self, given: str, element: str = "STRING") -> str:
        """A text that is a JSON list as an array; NULL for any other text. No lambdas: literals must fold."""
        listed = f"IF(trim({given}) LIKE '[%]', from_json({given}, 'array<string>'), NULL)"
        return listed if element == "STRING" else f"try_cast({listed} AS ARRAY<{element}>)"

    def names_in(self, name: str) -> str:
        """A parameter with one name or a JSON list of names, as an array."""
        given = self.parameter(name)
        return f"coalesce({self.list_in(given)}, array({given}))"

    def names_of(self, prop: Property) -> list[str]:
        """What a caller may call a property: its key, and its column where that differs."""
        return list(dict.fromkeys([prop.source_key, prop.name]))

    def lists_any(self, listed: str, names: list[str]) -> str:
        return "(" + " OR ".join(f"array_contains({listed}, {_text(name)})" for name in names) + ")"

    def is_or_in(self, column: str, given: str, data_type: T.DataType) -> str:
        """No condition for NULL, membership for a JSON list, else equality with the text in the column's type.

        Beside the membership stand its least and greatest value, which reach the scan. Integers are compared as
        decimals, as a fraction equals none of them.
        """
        sql_type, compared = data_type.simpleString(), column
        single = f"{column} = CAST({given} AS {sql_type})"
        if isinstance(data_type, (T.LongType, T.IntegerType)):
            number = f"CAST({given} AS {EXACT})"
            single = f"IF({number} = floor({number}), {column} = CAST(floor({number}) AS {sql_type}), false)"
            sql_type, compared = EXACT, f"CAST({column} AS {EXACT})"
        listed = self.list_in(given, "STRING" if sql_type == "string" else sql_type)
        least, most = (f"CAST({f}({listed}) AS {data_type.simpleString()})" for f in ("array_min", "array_max"))
        if sql_type == EXACT:
            least, most = (f"CAST({r}({f}({listed})) AS {data_type.simpleString()})" for r, f in (("floor", "array_min"), ("ceil", "array_max")))
        return (
            f"CASE WHEN {given} IS NULL THEN true WHEN {self.list_in(given)} IS NULL THEN {single} "
            f"ELSE {column} >= {least} AND {column} <= {most} AND array_contains({listed}, {compared}) END"
        )

    def bound(self, column: str, sign: str, value: str, data_type: T.DataType) -> str:
        """A comparison with a bound. For integers a fraction is first rounded to the side that keeps the meaning."""
        sql_type = data_type.simpleString()
        if isinstance(data_type, (T.LongType, T.IntegerType)):
            side = "floor" if sign in (">", "<=") else "ceil"
            return f"{column} {sign} CAST({side}(CAST({value} AS {EXACT})) AS {sql_type})"
        return f"{column} {sign} CAST({value} AS {sql_type})"

    def property_conditions(self, prop: Property) -> list[str]:
        column, names, given = f"t.{_name(prop.name)}", self.names_of(prop), self.parameter(prop.name)
        data_type = prop.spark_type
        conditions = [
            f"({self.parameter(p)} IS NULL OR NOT {self.lists_any(self.names_in(p), names)} OR {column} IS {kept})"
            for p, kept in (("_exists", "NOT NULL"), ("_not_exists", "NULL"))
        ]
        if isinstance(data_type, T.ArrayType):
            element = data_type.elementType.simpleString()
            listed = self.list_in(given, "STRING" if element == "string" else element)
            wanted = f"IF({self.list_in(given)} IS NULL, array(CAST({given} AS {element})), {listed})"
            return [*conditions, f"({given} IS NULL OR arrays_overlap({column}, {wanted}))"]
        conditions.append(self.is_or_in(column, given, data_type))
        for name, sign in COMPARISONS.items():
            bounds = f"from_json({self.parameter(name)}, 'map<string,string>')"
            value = "coalesce(" + ", ".join(f"{bounds}[{_text(n)}]" for n in names) + ", NULL)"
            conditions.append(f"({value} IS NULL OR {self.bound(column, sign, value, data_type)})")
        return conditions

    def guards(self) -> list[str]:
        """Names that the view lacks, and text that should be JSON but isn't, fail the call; nothing is left of these
        conditions in the plan of a call that is right."""
        known = ", ".join(_text(n) for p in self.view.properties for n in self.names_of(p))
        known = f"array({known})" if known else "CAST(array() AS array<string>)"
        fail = "CAST(raise_error(concat({0}, {1})) AS BOOLEAN)"
        unknown = _text(f"view {self.view.view_key} lacks some name in ")
        checks = []

        def check(name: str, names: str, allowed: str, shape: str | None) -> None:
            given = self.parameter(name)
            malformed = f"WHEN {names} IS NULL THEN {fail.format(_text(shape), given)} " if shape else ""
            checks.append(
                f"CASE WHEN {given} IS NULL THEN true {malformed}"
                f"WHEN size(array_except({names}, {allowed})) > 0 THEN {fail.format(unknown, given)} ELSE true END"
            )

        for name in ("_exists", "_not_exists"):
            check(name, self.names_in(name), known, None)
        for name in COMPARISONS:
            check(name, f"map_keys(from_json({self.parameter(name)}, 'map<string,string>'))", known, f"{name} is no JSON object: ")
        keys = f"concat({known}, array('space', 'externalId', 'external_id'))"
        check("_group_by", f"from_json({self.parameter('_group_by')}, 'array<string>')", keys, "_group_by is no JSON list: ")
        return checks

    def condition(self) -> str:
        parts = [*self.guards(), *(c for prop in self.view.properties for c in self.property_conditions(prop))]
        parts.append(self.is_or_in("t.space", self.parameter("instance_space"), T.StringType()))
        parts.append(self.is_or_in("t.external_id", self.parameter("external_id"), T.StringType()))
        return "\n      AND ".join(parts)

    def metrics(self) -> str:
        """The usable metrics asked for; more than allowed, none, or a wrong kind of property fails the query."""
        given = f"from_json({self.parameter('_aggregates')}, '{METRICS_TYPE}')"
        return (
            f"transform(filter({given}, m -> trim(m.fn) <> '' AND trim(m.property) <> ''), "
            f"m -> named_struct('fn', lower(trim(m.fn)), 'property', trim(m.property)))"
        )

    def checked(self) -> str:
        given = f"from_json({self.parameter('_aggregates')}, '{METRICS_TYPE}')"
        known = ", ".join(_text(p.source_key) for p in self.view.properties)
        numeric = ", ".join(_text(p.source_key) for p in self.view.properties if p.is_numeric) or "''"
        bad = (
            f"exists({self.metrics()}, m -> m.fn NOT IN ('count', 'min', 'max') "
            f"OR (m.fn <> 'count' AND m.property NOT IN ({numeric})) "
            f"OR m.property NOT IN ({known or _text('')}, 'externalId', 'external_id'))"
        )
        fail = "CAST(raise_error({}) AS BOOLEAN)"
        return (
            f"CASE WHEN size({given}) > {MAX_METRICS} THEN "
            + fail.format(_text(f"at most {MAX_METRICS} metrics in one aggregate"))
            + f" WHEN coalesce(size({self.metrics()}), 0) < 1 THEN "
            + fail.format(_text("an aggregate needs a list of metrics"))
            + f" WHEN {bad} THEN "
            + fail.format(_text("an aggregate is count, or min or max of a numeric property"))
            + " ELSE true END"
        )

    def grouped(self, *keys: str) -> str:
        listed = f"coalesce(from_json({self.parameter('_group_by')}, 'array<string>'), CAST(array() AS array<string>))"
        return " OR ".join(f"array_contains({listed}, {_text(key)})" for key in keys)

    def group_keys(self) -> list[str]:
        keys = [f"CASE WHEN {self.grouped(*self.names_of(p))} THEN t.{_name(p.name)} END" for p in self.view.properties]
        keys.append(f"CASE WHEN {self.grouped('space')} THEN t.space END")
        keys.append(f"CASE WHEN {self.grouped('externalId', 'external_id')} THEN t.external_id END")
        return keys

    def last_metric(self, *keys: str) -> str:
        listed = ", ".join(_text(k) for k in keys)
        return f"try_element_at(filter({self.metrics()}, m -> m.property IN ({listed})), -1).fn"

    def metric_columns(self, keys: list[str]) -> list[str]:
        """The view's columns with metrics in them; a metric takes its property's column, over a group key."""
        columns = []
        for prop, key in zip(self.view.properties, keys, strict=False):
            column, sql_type = f"t.{_name(prop.name)}", prop.spark_type.simpleString()
            metric = self.last_metric(prop.source_key)
            cases = f"WHEN {metric} = 'count' THEN try_cast(CAST(count({column}) AS STRING) AS {sql_type})"
            if prop.is_array:
                cases = f"WHEN {metric} = 'count' THEN NULL"
            elif prop.is_numeric:
                cases += f" WHEN {metric} = 'min' THEN min({column}) WHEN {metric} = 'max' THEN max({column})"
            columns.append(f"CASE {cases} ELSE {key} END AS {_name(prop.name)}")
        counted = self.last_metric("externalId", "external_id")
        columns.append(f"{keys[-2]} AS space")
        columns.append(f"CASE WHEN {counted} = 'count' THEN CAST(count(1) AS STRING) ELSE {keys[-1]} END AS external_id")
        columns += [f"CAST(NULL AS TIMESTAMP) AS {c}" for c in LIFECYCLE_COLUMNS]
        return columns

    def statement(self, temporary: bool) -> str:
        view, condition = self.view, self.condition()
        parameters = [f"{_name(p.name)} STRING DEFAULT NULL" for p in view.properties]
        parameters += [f"{_name(n)} {t} DEFAULT NULL" for n, t in PUSHDOWN_PARAMETERS.items()]
        returns = ", ".join(f"{_name(f.name)} {f.dataType.simpleString()}" for f in view.schema.fields)
        columns = [*(p.name for p in view.properties), *IDENTITY_COLUMNS, *LIFECYCLE_COLUMNS]
        plain = ", ".join(
            f"CAST(t.{_name(c)} AS {f.dataType.simpleString()}) AS {_name(c)}"
            for c, f in zip(columns, view.schema.fields, strict=True)
        )
        names = ", ".join(_name(c) for c in columns)
        mode = f"coalesce(lower(trim({self.parameter('_query_mode')})), 'list') = 'aggregate'"
        limit = self.parameter("_row_limit")
        no_groups = f"coalesce(size(from_json({self.parameter('_group_by')}, 'array<string>')), 0) < 1"
        nothing = ["CAST(NULL AS STRING)"] * 2
        none = [f"CAST(NULL AS {p.spark_type.simpleString()})" for p in view.properties] + nothing
        keys = self.group_keys()
        # Any rows meet a limit, but the same ones every time: buckets are counted, and only rows of the one bucket that
        # the limit cuts are ranked. The one window without a partition is over the buckets' counts.
        limited = f"NOT ({mode}) AND coalesce({limit}, -1) >= 0\n      AND {condition}"
        bucket = f"CAST(pmod(xxhash64(t.space, t.external_id), {LIMIT_BUCKETS}) AS INT)"
        counted = f"SELECT {bucket} AS _bucket, count(1) AS _n FROM {self.source} t WHERE {limited} GROUP BY 1"
        filled = f"SELECT _bucket, _n, sum(_n) OVER (ORDER BY _bucket) AS _upto FROM ({counted})"
        rows = f"SELECT {plain}, {bucket} AS _bucket FROM {self.source} t WHERE {limited}"
        return f"""
CREATE OR REPLACE {'TEMPORARY FUNCTION' if temporary else 'FUNCTION'} {_qualified(self.name)}({', '.join(parameters)})
RETURNS TABLE({returns})
RETURN
  SELECT {plain} FROM {self.source} t
    WHERE NOT ({mode}) AND coalesce({limit}, -1) < 0
      AND {condition}
  UNION ALL
  SELECT {names} FROM ({rows}) JOIN ({filled}) USING (_bucket) WHERE _upto <= {limit}
  UNION ALL
  SELECT {names} FROM (
    SELECT *, row_number() OVER (PARTITION BY _bucket ORDER BY space, external_id) AS _rank
    FROM ({rows}) JOIN (SELECT * FROM ({filled}) WHERE _upto > {limit} AND _upto - _n < {limit}) USING (_bucket))
    WHERE _rank <= {limit} - (_upto - _n)
  UNION ALL
  SELECT {names} FROM (
    SELECT {', '.join(self.metric_columns(none))} FROM {self.source} t
    WHERE {mode} AND {no_groups} AND {self.checked()}
      AND {condition}) WHERE {mode} AND {no_groups}
  UNION ALL
  SELECT {names} FROM (
    SELECT {', '.join(self.metric_columns(keys))} FROM {self.source} t
    WHERE {mode} AND NOT ({no_groups}) AND {self.checked()}
      AND {condition}
    GROUP BY {', '.join(keys)})"""


def view_function_ddl(view: ViewDef, source: str, name: str | None = None, temporary: bool = True) -> str:
    """A table function: one optional parameter per property, then the filter, limit and aggregate parameters."""
    return _ViewFunction(view, source, name or function_name_for(view.external_id)).statement(temporary)


def create_view_function(spark: SparkSession, view: ViewDef, source: str, name: str | None = None) -> None:
    spark.sql(view_function_ddl(view, source, name))


# Time-series functions


def _time_sql(given: str) -> str:
    """SQL form of a time argument, see viewloom.functions.timing."""
    text = f"lower(trim({given}))"
    seconds = " ".join(f"WHEN '{unit}' THEN {size}" for unit, size in UNIT_SECONDS.items())
    shift = (
        f"CAST(regexp_extract({text}, {_text(RELATIVE)}, 1) AS BIGINT) "
        f"* CASE regexp_extract({text}, {_text(RELATIVE)}, 2) {seconds} END "
        f"* IF({text} LIKE '%ago', -1, 1)"
    )
    return (
        f"date_trunc('millisecond', CASE WHEN {text} = 'now' THEN current_timestamp() "
        f"WHEN {text} RLIKE {_text(RELATIVE)} THEN timestampadd(SECOND, {shift}, current_timestamp()) "
        f"WHEN {text} RLIKE '^-?[0-9]+$' THEN timestamp_millis(CAST({text} AS BIGINT)) "
        f"WHEN upper({text}) RLIKE {_text(ISO)} THEN CAST(upper({text}) AS TIMESTAMP) "
        f"ELSE CAST(raise_error(concat('not a time: ', {given})) AS TIMESTAMP) END)"
    )


def _width_sql(given: str) -> str:
    """SQL form of a granularity, in microseconds."""
    seconds = " ".join(f"WHEN '{unit}' THEN {size}" for unit, size in UNIT_SECONDS.items())
    text = f"lower(trim({given}))"
    return f"(CAST(substring({text}, 1, length({text}) - 1) AS BIGINT) * CASE right({text}, 1) {seconds} END * 1000000)"


# An id text: a space with something in it, the first colon, and an external id with something in it.
INSTANCE_ID = "^[^:]*[^: ][^:]*:.*[^ ].*$"


def _rolled_sql(points: str, aggregate: str, width: str, names: list[str]) -> str:
    """Plain aggregates per bucket. All of them are computed by name and those not asked for are pruned."""
    sums = ", ".join(f"{PLAIN_SQL[SQL_AGGREGATES.get(n, n)]} AS {n}" for n in dict.fromkeys(names))
    cases = " ".join(f"WHEN '{n}' THEN {n}" for n in dict.fromkeys(names))
    return f"""
  SELECT timestamp_micros(bucket) AS timestamp, CASE lower(trim({aggregate})) {cases} END AS value, external_id, space
  FROM (SELECT space, external_id, bucket, {sums} FROM (
      SELECT space, external_id, value, at - pmod(at, {width}) AS bucket FROM ({points}))
    GROUP BY space, external_id, bucket)"""


SERIES_KEY = "space, external_id"


def _ordered_sql(points: str, aggregate: str, width: str) -> str:
    """Segment sums per bucket, as in viewloom.operators.rollups: inside stretches, then across their ends."""
    key = f"{SERIES_KEY}, bucket"
    steps, stretch, joins = map(", ".join, ordered_sums(f"(PARTITION BY {key}, stretch ORDER BY at)", f"(PARTITION BY {key} ORDER BY stretch)"))
    results = " ".join(f"WHEN '{name}' THEN {result}" for name, result in ORDERED_RESULTS.items())
    return f"""
  SELECT timestamp_micros(bucket) AS timestamp, CASE lower(trim({aggregate})) {results} END AS value, external_id, space
  FROM (SELECT {key}, {', '.join(bucket_sums())} FROM (
      SELECT *, {joins} FROM (
        SELECT {key}, stretch, {stretch} FROM (SELECT *, {steps} FROM (
            SELECT {SERIES_KEY}, value, at, at - pmod(at, {width}) AS bucket,
              at - pmod(at, least({width}, {STRETCH})) AS stretch FROM ({points})))
        GROUP BY {key}, stretch))
    GROUP BY {key})"""


def _gridded_sql(every: str, aggregate: str, width: str, start: str, end: str) -> str:
    """Values at every bucket start, as in viewloom.operators.rollups: inside blocks, with what lies around each.
    ``every`` has the points of all times."""
    points = f"SELECT * FROM ({every}) WHERE at >= {start} AND at < {end}"
    block = f"({width} * {GRID_BUCKETS})"
    first = f"(-(floor(-({start}) / {width})) * {width})"
    last = f"(-(floor(-({end}) / {width})) * {width} - {width})"
    low, high = (f"({x} - pmod({x}, {block}))" for x in (start, f"greatest({last}, {start})"))
    edges = f"""SELECT {SERIES_KEY}, block, min(at) AS first_at, min_by(value, at) AS first_value,
        max(at) AS last_at, max_by(value, at) AS last_value
      FROM (SELECT {SERIES_KEY}, value, at, at - pmod(at, {block}) AS block, at - pmod(at, {width}) AS bucket
        FROM ({points})) GROUP BY {SERIES_KEY}, block, bucket"""
    held = f"""SELECT {SERIES_KEY}, block, min(first_at) AS first_at, min_by(first_value, first_at) AS first_value,
        max(last_at) AS last_at, max_by(last_value, last_at) AS last_value
      FROM ({edges}) GROUP BY {SERIES_KEY}, block
      UNION ALL SELECT {SERIES_KEY}, {low} - {block}, at, value, at, value FROM (
        SELECT {SERIES_KEY}, max(at) AS at, max_by(value, at) AS value FROM ({every}) WHERE at < {start} GROUP BY {SERIES_KEY})
      UNION ALL SELECT {SERIES_KEY}, {high} + {block}, at, value, at, value FROM (
        SELECT {SERIES_KEY}, min(at) AS at, min_by(value, at) AS value FROM ({every}) WHERE at >= {end} GROUP BY {SERIES_KEY})"""
    near = "RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    before = f"(PARTITION BY {SERIES_KEY} ORDER BY block {near})"
    after = f"(PARTITION BY {SERIES_KEY} ORDER BY block DESC {near})"
    carried = f"""SELECT {SERIES_KEY}, block, is_mark, last(last_at, true) OVER {before} AS at0,
        last(last_value, true) OVER {before} AS v0, last(first_at, true) OVER {after} AS at1,
        last(first_value, true) OVER {after} AS v1
      FROM (SELECT {SERIES_KEY}, block, 0 AS is_mark, first_at, first_value, last_at, last_value FROM ({held})
        UNION ALL SELECT {SERIES_KEY}, explode(wanted) AS block, 1,
          CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE), CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE)
        FROM (SELECT {SERIES_KEY}, sequence({low}, {high}, {block}) AS wanted
          FROM (SELECT DISTINCT {SERIES_KEY} FROM ({held}))))"""
    lowest, highest = f"greatest(block, {first})", f"least(block + {block} - {width}, {last})"
    marks = f"""SELECT {SERIES_KEY}, block, explode(wanted) AS at,
        CAST(NULL AS DOUBLE) AS value, 1 AS is_mark, at0, v0, at1, v1
      FROM (SELECT *, sequence({lowest}, {highest}, {width}) AS wanted FROM ({carried})
        WHERE is_mark = 1 AND {lowest} <= {highest})"""
    known = f"""SELECT {SERIES_KEY}, block, inline(array(struct(first_at AS at, first_value AS value), struct(last_at AS at, last_value AS value)))
        AS (at, value), 0 AS is_mark, CAST(NULL AS BIGINT) AS at0, CAST(NULL AS DOUBLE) AS v0,
        CAST(NULL AS BIGINT) AS at1, CAST(NULL AS DOUBLE) AS v1 FROM ({edges})"""
    rows = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    back = f"(PARTITION BY {SERIES_KEY}, block ORDER BY at, is_mark {rows})"
    ahead = f"(PARTITION BY {SERIES_KEY}, block ORDER BY at DESC, is_mark {rows})"
    point_at, point_value = "IF(is_mark = 0, at, NULL)", "IF(is_mark = 0, value, NULL)"
    return f"""
  SELECT * FROM (
  SELECT timestamp_micros(at) AS timestamp, CASE WHEN lower(trim({aggregate})) = 'stepinterpolation' OR p0 = at THEN w0
      WHEN p1 IS NOT NULL THEN w0 + (w1 - w0) * ((at - p0) / (p1 - p0)) END AS value, external_id, space
  FROM (SELECT {SERIES_KEY}, at, is_mark,
      coalesce(last({point_at}, true) OVER {back}, at0) AS p0, coalesce(last({point_value}, true) OVER {back}, v0) AS w0,
      coalesce(last({point_at}, true) OVER {ahead}, at1) AS p1,
      coalesce(last({point_value}, true) OVER {ahead}, v1) AS w1
    FROM ({known} UNION ALL {marks})) WHERE is_mark = 1) WHERE value IS NOT NULL"""


def _any_aggregate_sql(points: str, every: str, aggregate: str, width: str, start: str, end: str) -> str:
    """The ten aggregates in one relation; with a literal aggregate only its own branch stays in the plan."""
    named = f"lower(trim({aggregate}))"
    unknown = f"CAST(raise_error(concat('unknown aggregate ', {aggregate})) AS BOOLEAN)"
    branches = [
        (list(PLAIN), _rolled_sql(points, aggregate, width, list(PLAIN))),
        (ORDERED, _ordered_sql(points, aggregate, width)),
        (GRIDDED, _gridded_sql(every, aggregate, width, start, end)),
    ]
    listed = lambda names: ", ".join(_text(n) for n in names)
    parts = [f"SELECT * FROM ({sql}) WHERE {named} IN ({listed(names)})" for names, sql in branches]
    known = f"IF({named} IN ({listed(AGGREGATES)}), false, {unknown})"
    parts[0] += f" OR {known}"
    return "\n  UNION ALL ".join(parts)


def series_function_ddl(
    source: str, ts_type: str, optional: set[str], temporary: bool = True, database: str | None = None
) -> dict[str, str]:
    """The four series functions over a datapoint table whose ``ts`` has the given SQL type; permanent ones in ``database``."""
    create = f"CREATE OR REPLACE {'TEMPORARY ' if temporary else ''}FUNCTION"
    within = f"{_qualified(database)}." if database else ""
    code = "p.status_code" if "status_code" in optional else "CAST(NULL AS INT)"
    symbol = "p.status_symbol" if "status_symbol" in optional else "CAST(NULL AS STRING)"
    placed = "p.space, p.external_id, p.value, unix_micros(CAST(p.ts AS TIMESTAMP)) AS at"
    bad_id = "CAST(raise_error(concat('an instance id looks like space:external_id, not ', {0})) AS BOOLEAN)"

    def arg(function: str, name: str) -> str:
        return f"{function}.{_name(name)}"

    def in_range(function: str, start: str, end: str) -> str:
        first, last = _time_sql(arg(function, start)), _time_sql(arg(function, end))
        return f"p.ts >= CAST({first} AS {ts_type}) AND p.ts < CAST({last} AS {ts_type})"

    def every_series(function: str, columns: str, ranged: bool = True) -> str:
        return f"SELECT {columns} FROM {source} p WHERE {in_range(function, 'start', 'end') if ranged else 'p.value IS NOT NULL'}"

    def named_series(function: str) -> str:
        """The series that one id text names, split at its first colon.

        This condition stands above the aggregates, whose keys it is on: Spark pushes a literal id down to the scan,
        and turns the id of an outer row into a single join. Below them an outer id would cost a join per branch.
        """
        given = arg(function, "instance_id")
        good = f"{given} IS NULL OR trim({given}) RLIKE '{INSTANCE_ID}'"
        # The check sits inside the compared value: beside it, a bad literal id would fold away without an error.
        checked = f"IF({good}, {given}, {bad_id.format(given).replace('AS BOOLEAN', 'AS STRING')})"
        return (
            f"space = trim(substring_index({checked}, ':', 1)) "
            f"AND external_id = trim(substring({checked}, instr({given}, ':') + 1))"
        )

    def wanted(function: str) -> str:
        """The (space, external_id) pairs of a comma list of ids; blanks are skipped."""
        ids = arg(function, "instance_ids")
        return (
            "SELECT trim(substring_index(id, ':', 1)) AS s, trim(substring(id, instr(id, ':') + 1)) AS e "
            f"FROM (SELECT DISTINCT trim(item) AS id FROM (SELECT explode(split({ids}, ',')) AS item)) "
            f"WHERE id <> '' AND IF(id RLIKE '{INSTANCE_ID}', true, {bad_id.format('id')})"
        )

    def near(function: str) -> str:
        """Least and greatest space and external id of a list of ids: without lambdas, so that they fold and reach the scan."""
        tidy = f"regexp_replace(trim({arg(function, 'instance_ids')}), ' *, *', ',')"
        spaces, ids = f"regexp_replace({tidy}, ' *:[^,]*', '')", f"regexp_replace({tidy}, '(^|,)[^:,]*: *', '$1')"
        listed = ((c, f"array_remove(split({text}, ','), '')") for c, text in (("p.space", spaces), ("p.external_id", ids)))
        return " AND ".join(f"{c} >= array_min({items}) AND {c} <= array_max({items})" for c, items in listed)

    def many_series(function: str, columns: str, condition: str) -> str:
        return (
            f"SELECT {columns} FROM {source} p JOIN ({wanted(function)}) ids "
            f"ON p.space = ids.s AND p.external_id = ids.e WHERE {near(function)} AND {condition}"
        )

    def aggregated(function: str, points: str, every: str) -> str:
        first, last = (f"unix_micros({_time_sql(arg(function, n))})" for n in ("start", "end"))
        name, width = arg(function, "aggregates"), _width_sql(arg(function, "granularity"))
        return _any_aggregate_sql(points, every, name, width, first, last)

    def pair(function: str) -> str:
        same = f"({arg(function, 'aggregates')} IS NULL) = ({arg(function, 'granularity')} IS NULL)"
        return f"IF({same}, true, CAST(raise_error('aggregates and granularity go together') AS BOOLEAN))"

    one, many = "time_series_datapoints_udtf", "time_series_datapoints_detailed_udtf"
    rolled, latest = "time_series_sql_udtf", "time_series_latest_datapoints_udtf"
    ranged = (
        "`start` STRING DEFAULT '2w-ago', `end` STRING DEFAULT 'now', "
        "aggregates STRING DEFAULT NULL, granularity STRING DEFAULT NULL"
    )
    hinted = many_series(rolled, placed, in_range(rolled, "start_hint", "end_hint"))
    hint_name, hint_width = arg(rolled, "aggregate_hint"), _width_sql(arg(rolled, "granularity_hint"))
    hints = [arg(rolled, n) for n in ("start_hint", "end_hint", "aggregate_hint", "granularity_hint")]
    unknown_hint = f"CAST(raise_error(concat('unknown aggregate ', {hint_name})) AS BOOLEAN)"
    known_hint = ", ".join(_text(n) for n in SQL_AGGREGATES)
    before = _time_sql(f"coalesce({arg(latest, 'before')}, 'now')")
    return {
        one: f"""{create} {within}{one}(instance_id STRING, {ranged})
RETURNS TABLE(timestamp TIMESTAMP, value DOUBLE) RETURN
  SELECT timestamp, value FROM (
    SELECT space, external_id, CAST(ts AS TIMESTAMP) AS timestamp, value FROM ({every_series(one, 'p.*')})
      WHERE {arg(one, 'aggregates')} IS NULL
    UNION ALL
    SELECT space, external_id, timestamp, value FROM ({aggregated(one, every_series(one, placed), every_series(one, placed, False))})
      WHERE {arg(one, 'aggregates')} IS NOT NULL)
  WHERE {named_series(one)} AND {pair(one)}""",
        many: f"""{create} {within}{many}(instance_ids STRING, {ranged})
RETURNS TABLE(timestamp TIMESTAMP, value DOUBLE, status_code INT, status_symbol STRING, external_id STRING, space STRING)
RETURN
  SELECT CAST(ts AS TIMESTAMP) AS timestamp, value, code, symbol, external_id, space
    FROM ({many_series(many, f'p.*, {code} AS code, {symbol} AS symbol', in_range(many, 'start', 'end'))})
    WHERE {arg(many, 'aggregates')} IS NULL AND {pair(many)}
  UNION ALL
  SELECT timestamp, value, CAST(NULL AS INT), CAST(NULL AS STRING), external_id, space
    FROM ({aggregated(many, many_series(many, placed, in_range(many, 'start', 'end')), many_series(many, placed, 'p.value IS NOT NULL'))})
    WHERE {arg(many, 'aggregates')} IS NOT NULL AND {pair(many)}""",
        rolled: f"""{create} {within}{rolled}(instance_ids STRING, start_hint STRING, end_hint STRING,
  aggregate_hint STRING, granularity_hint STRING)
RETURNS TABLE(timestamp TIMESTAMP, value DOUBLE, external_id STRING, space STRING) RETURN
  SELECT * FROM ({_rolled_sql(hinted, hint_name, hint_width, list(SQL_AGGREGATES))})
    WHERE IF({' IS NULL OR '.join(hints)} IS NULL, CAST(raise_error('every hint is required') AS BOOLEAN),
      IF(lower(trim({hint_name})) IN ({known_hint}), true, {unknown_hint}))""",
        latest: f"""{create} {within}{latest}(instance_ids STRING, before STRING DEFAULT 'now',
  include_status BOOLEAN DEFAULT false)
RETURNS TABLE(time_series_external_id STRING, timestamp TIMESTAMP, value DOUBLE, status_code INT) RETURN
  SELECT concat(space, ':', external_id), CAST(ts AS TIMESTAMP), value, IF({arg(latest, 'include_status')}, code, NULL)
  FROM (SELECT space, external_id, max(ts) AS ts, max_by(value, ts) AS value, max_by(code, ts) AS code
    FROM ({many_series(latest, f'p.*, {code} AS code', f'p.ts < CAST({before} AS {ts_type})')}) GROUP BY space, external_id)""",
    }


def create_series_functions(spark: SparkSession, source: str, database: str | None = None) -> list[str]:
    """The series functions over a registered table: for the session, or permanent ones in a database of the catalog."""
    schema = spark.table(source).schema
    ts_type = "TIMESTAMP_NTZ" if isinstance(schema["ts"].dataType, T.TimestampNTZType) else "TIMESTAMP"
    statements = series_function_ddl(source, ts_type, set(schema.fieldNames()), database is None, database)
    for statement in statements.values():
        spark.sql(statement)
    return list(statements)


def create_catalog_functions(spark: SparkSession, database: str, model: dict[str, ViewDef], points: str | None = None) -> list[str]:
    """Permanent SQL views and table functions in a database of the catalog, for every session that shares it: for each view of
    the model, given as catalog table -> view, and the series functions over the datapoint table ``points``. Returns their names.

    Spark's grammar has no database before a table function's name: callers ``USE`` the database. Views take their full name.
    """
    made = []
    for source, view in model.items():
        for name, ddl in ((view.external_id, view_ddl), (function_name_for(view.external_id), view_function_ddl)):
            spark.sql(ddl(view, source, f"{database}.{name}", temporary=False))
            made.append(f"{database}.{name}")
    if points:
        made += [f"{database}.{name}" for name in create_series_functions(spark, points, database)]
    return made
