"""Queries over raw JSON: instance pages, property resolution, value coercion, series payloads and id and time text.

The JSON is derived from the given tables: every order becomes an instance record, every event a datapoint, and the
coerced values take the different JSON shapes in turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewloom.functions.coercion import coerce_columns, relation_id
from viewloom.functions.identity import instance_id_array, instance_id_struct
from viewloom.functions.timing import resolve_time_column
from viewloom.model import Property, ViewDef
from viewloom.plans.sql_surface import create_view_function
from viewloom.sources.payloads import unnest_payloads
from viewloom.sources.records import parse_items, resolve, unnest_pages
from workload.registry import registrar
from workload.tables import ORDER_VIEW, POINTS_SQL, points, read

QUERIES = {}
ORACLES = {}

# Instances per page; payloads hold an hour of one series. Real pages and payloads are bounded by their writers.
PAGE = 100


query = registrar(QUERIES, ORACLES)


def _properties() -> Column:
    """An order's view properties as a JSON object with a relation, an epoch date, a missing and a text number."""
    key = F.col("o_orderkey")
    return F.struct(
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("totalPrice"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("orderDate"),
        F.col("o_orderpriority").alias("class"),
        F.struct(
            F.lit("people").alias("space"), F.concat(F.lit("customer_"), "o_custkey").alias("externalId")
        ).alias("customer"),
        F.when(key % 5 != 0, F.concat(F.lit("note "), key)).alias("shipNote"),
        F.pmod(key, F.lit(40)).cast("string").alias("clerk"),
    )


def _envelope(*more: Column) -> Column:
    return F.to_json(
        F.struct(
            F.lit("node").alias("instanceType"),
            F.concat(F.lit("plant_"), "o_orderstatus").alias("space"),
            F.concat(F.lit("order_"), "o_orderkey").alias("externalId"),
            F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("createdTime"),
            F.lit(0).alias("lastUpdatedTime"),
            *more,
        )
    )


def _nested(space: str, properties: Column) -> Column:
    return F.struct(F.struct(properties.alias(ORDER_VIEW.view_key)).alias(space))


def _pages(records: DataFrame, key: str, record: str) -> DataFrame:
    """Records in pages of at most ``PAGE`` items, which the key's range bounds."""
    return records.groupBy(F.floor(F.col(key) / PAGE).alias("page_no")).agg(
        F.concat(F.lit('{"items": ['), F.array_join(F.collect_list(record), ","), F.lit("]}")).alias("page")
    )


RESOLVED_SQL = """SELECT o_orderstatus AS status, o_totalprice AS "totalPrice", o_orderdate AS "orderDate",
    o_orderpriority AS class_, 'customer_' || o_custkey AS customer,
    CASE WHEN o_orderkey % 5 <> 0 THEN 'note ' || o_orderkey END AS "shipNote", o_orderkey % 40 AS clerk,
    'plant_' || o_orderstatus AS space, 'order_' || o_orderkey AS external_id, o_orderdate AS "createdTime",
    TIMESTAMP '1970-01-01 00:00:00' AS "lastUpdatedTime", CAST(NULL AS TIMESTAMP) AS "deletedTime" FROM orders"""


@query(RESOLVED_SQL)
def page_unnest(spark, sf_dir):
    record = _envelope(_nested(ORDER_VIEW.space, _properties()).alias("properties"))
    records = read(spark, sf_dir, "orders").select("o_orderkey", record.alias("record"))
    pages = _pages(records, "o_orderkey", "record").select("page")
    return resolve(unnest_pages(pages, ORDER_VIEW), ORDER_VIEW)


@query(f"""SELECT external_id, class_, "totalPrice" FROM ({RESOLVED_SQL})
    WHERE class_ IN ('1-URGENT', '2-HIGH') AND "totalPrice" > 1000.5 AND "shipNote" IS NOT NULL AND space = 'plant_O'""")
def raw_pages_to_sql(spark, sf_dir):
    """From pages of JSON to a filtered call of the view's SQL function, which reads only the properties it needs."""
    page_unnest(spark, sf_dir).createOrReplaceTempView("raw_orders")
    create_view_function(spark, ORDER_VIEW, "raw_orders", "raw_order_view_udtf")
    return spark.sql("""SELECT external_id, class_, totalPrice FROM raw_order_view_udtf(class_ => '["1-URGENT", "2-HIGH"]',
      _gt => '{"totalPrice": 1000.5}', _exists => 'shipNote', instance_space => 'plant_O')""")


@query(RESOLVED_SQL)
def resolve_properties(spark, sf_dir):
    """A third of the records under the view's space, a third under another one, a third at the top level."""
    kind = F.pmod("o_orderkey", F.lit(3))
    own = _envelope(_nested(ORDER_VIEW.space, _properties()).alias("properties"))
    other = _envelope(_nested("elsewhere", _properties()).alias("properties"))
    flat = _envelope(*[_properties()[p.source_key].alias(p.source_key) for p in ORDER_VIEW.properties])
    record = F.when(kind == 0, own).when(kind == 1, other).otherwise(flat)
    return resolve(parse_items(read(spark, sf_dir, "orders").select(record.alias("record")), ORDER_VIEW), ORDER_VIEW)


def _stale() -> Column:
    """Nested properties that the ones in ``sources`` must win over, except where those are null."""
    return F.struct(
        F.lit("stale").alias("status"),
        F.lit(-1.0).alias("totalPrice"),
        F.when(F.col("o_orderkey") % 10 == 0, F.lit("kept")).alias("shipNote"),
    )


STALE_SQL = RESOLVED_SQL.replace(
    "THEN 'note ' || o_orderkey END", "THEN 'note ' || o_orderkey WHEN o_orderkey % 10 = 0 THEN 'kept' END"
)


@query(STALE_SQL)
def resolve_sources_list(spark, sf_dir):
    def entry(external_id: str, version: str, properties: Column) -> Column:
        source = F.struct(
            F.lit(ORDER_VIEW.space).alias("space"),
            F.lit(external_id).alias("externalId"),
            F.lit(version).alias("version"),
        )
        return F.to_json(F.struct(source.alias("source"), properties.alias("properties")))

    sources = F.concat(
        F.lit("["),
        entry(ORDER_VIEW.external_id, "v0", _stale()),
        F.lit(","),
        entry(ORDER_VIEW.external_id, ORDER_VIEW.version, _properties()),
        F.lit("]"),
    )
    return resolve(parse_items(_with_sources(spark, sf_dir, sources), ORDER_VIEW), ORDER_VIEW)


@query(STALE_SQL)
def resolve_sources_map(spark, sf_dir):
    sources = F.to_json(F.struct(_properties().alias(ORDER_VIEW.view_key), _stale().alias("OrderView/v0")))
    return resolve(parse_items(_with_sources(spark, sf_dir, sources), ORDER_VIEW), ORDER_VIEW)


def _with_sources(spark, sf_dir: str, sources: Column) -> DataFrame:
    envelope = _envelope(_nested(ORDER_VIEW.space, _stale()).alias("properties"))
    record = F.concat(F.expr(f"substring({'e'}, 1, length({'e'}) - 1)"), F.lit(', "sources": '), "s", F.lit("}"))
    rows = read(spark, sf_dir, "orders").select(envelope.alias("e"), sources.alias("s"))
    return rows.select(record.alias("record"))


WIDE_VIEW = ViewDef("sales", "WideOrderView", "v1", tuple(Property(f"field{i}") for i in range(181)))


@query("SELECT " + ", ".join(f"CASE WHEN (o_orderkey + {i}) % 7 <> 0 THEN '{i}:' || o_orderkey END AS field{i}" for i in range(181))
    + """, 'plant_' || o_orderstatus AS space, 'order_' || o_orderkey AS external_id, o_orderdate AS "createdTime",
    TIMESTAMP '1970-01-01 00:00:00' AS "lastUpdatedTime", CAST(NULL AS TIMESTAMP) AS "deletedTime" FROM orders""")
def resolve_wide(spark, sf_dir):
    """A view of 181 text properties."""
    # A record has 200 times the bytes of its order, so rows are dealt out before; AQE would size partitions by the orders' bytes.
    rows = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    rows = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).withColumn("key_text", F.col("o_orderkey").cast("string"))
    key = F.col("o_orderkey")
    fields = [
        F.when((key + i) % 7 != 0, F.concat(F.lit(f"{i}:"), "key_text")).alias(p.source_key) for i, p in enumerate(WIDE_VIEW.properties)
    ]
    properties = F.struct(F.struct(F.struct(*fields).alias(WIDE_VIEW.view_key)).alias(WIDE_VIEW.space))
    record = _envelope(properties.alias("properties"))
    return resolve(parse_items(rows.select(record.alias("record")), WIDE_VIEW), WIDE_VIEW)


NOTE_VIEW = ViewDef("sales", "NoteView", "v1", (Property("note"), Property("total", "float64")))


@query("""SELECT CASE o_orderkey % 3 WHEN 0 THEN '{"z": "' || o_orderpriority || '", "a": [' || o_orderkey || ', "x,y:z \\" é"]}'
      WHEN 1 THEN '[{"q": ' || o_orderkey || ', "b": null}, true]' ELSE o_orderpriority END AS note, o_totalprice AS total,
    'plant_' || o_orderstatus AS space, 'order_' || o_orderkey AS external_id, o_orderdate AS "createdTime",
    TIMESTAMP '1970-01-01 00:00:00' AS "lastUpdatedTime", CAST(NULL AS TIMESTAMP) AS "deletedTime" FROM orders""")
def resolve_json_text(spark, sf_dir):
    """Objects and lists in a text property keep the order of their keys."""
    kind, key = F.pmod("o_orderkey", F.lit(3)), F.col("o_orderkey")
    note = (
        F.when(kind == 0, F.concat(F.lit('{"z":"'), "o_orderpriority", F.lit('","a":['), key, F.lit(',"x,y:z \\" é"]}')))
        .when(kind == 1, F.concat(F.lit('[{"q":'), key, F.lit(',"b":null},true]')))
        .otherwise(_quoted(F.col("o_orderpriority")))
    )
    properties = F.concat(
        F.lit(f', "properties": {{"{NOTE_VIEW.space}": {{"{NOTE_VIEW.view_key}": {{"note": '), note, F.lit(', "total": '), "o_totalprice", F.lit("}}}}")
    )
    envelope = _envelope().alias("e")
    rows = read(spark, sf_dir, "orders").select(envelope, properties.alias("p"))
    record = F.concat(F.expr("substring(e, 1, length(e) - 1)"), "p")
    return resolve(parse_items(rows.select(record.alias("record")), NOTE_VIEW), NOTE_VIEW)


# Coercion: each line item or order gives one JSON text, whose shape depends on its key


def _coerced(rows: DataFrame, keys: list[str], json: Column, columns: dict[str, T.DataType]) -> DataFrame:
    parsed = rows.select(*keys, F.parse_json(json).alias("v"))
    return coerce_columns(parsed, {name: (F.col("v"), t) for name, t in columns.items()}, tuple(keys))


LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey"]


@query("""SELECT l_orderkey, l_linenumber, l_partkey,
    CASE l_partkey % 7 WHEN 0 THEN l_suppkey WHEN 1 THEN l_suppkey WHEN 2 THEN CAST(floor(l_extendedprice) AS BIGINT)
      WHEN 5 THEN 1 END AS as_long,
    CASE l_partkey % 7 WHEN 0 THEN CAST(l_suppkey AS DOUBLE) WHEN 1 THEN CAST(l_suppkey AS DOUBLE)
      WHEN 2 THEN l_extendedprice WHEN 3 THEN l_extendedprice WHEN 5 THEN 1.0 END AS as_double,
    CASE l_partkey % 7 WHEN 0 THEN l_suppkey <> 0 WHEN 1 THEN l_suppkey = 1 WHEN 2 THEN true WHEN 3 THEN false
      WHEN 4 THEN l_returnflag = 'A' WHEN 5 THEN true END AS as_boolean
    FROM lineitem""")
def coerce_scalars(spark, sf_dir):
    """In turn: an integer, integer text, a fraction, fraction text, a yes or no word, true, and null."""
    as_text = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    kind = F.pmod("l_partkey", F.lit(7))
    price, supplier = F.col("l_extendedprice"), F.col("l_suppkey")
    price_text = F.format_string("%.2f", price)
    json = (
        F.when(kind == 0, supplier.cast("string"))
        .when(kind == 1, as_text(supplier))
        .when(kind == 2, price_text)
        .when(kind == 3, as_text(price_text))
        .when(kind == 4, as_text(F.when(F.col("l_returnflag") == "A", " Yes ").otherwise("never")))
        .when(kind == 5, F.lit("true"))
        .otherwise(F.lit("null"))
    )
    columns = {"as_long": T.LongType(), "as_double": T.DoubleType(), "as_boolean": T.BooleanType()}
    return _coerced(read(spark, sf_dir, "lineitem"), LINE_KEYS, json, columns)


@query("""SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN o_orderdate WHEN 1 THEN o_orderdate
      WHEN 2 THEN o_orderdate - INTERVAL 2 HOUR WHEN 3 THEN o_orderdate + INTERVAL 500 MILLISECOND END AS as_timestamp,
    CASE WHEN o_orderkey % 6 IN (0, 1, 2, 3) THEN CAST(o_orderdate AS DATE) END AS as_date FROM orders""")
def coerce_temporal(spark, sf_dir):
    """In turn: epoch milliseconds, an ISO date, ISO with an offset, ISO with a fraction and Z, blank, and junk."""
    kind, moment = F.pmod("o_orderkey", F.lit(6)), F.col("o_orderdate")
    day = F.date_format(moment, "yyyy-MM-dd")
    text = (
        F.when(kind == 1, day)
        .when(kind == 2, F.concat(day, F.lit("T00:00:00+02:00")))
        .when(kind == 3, F.concat(day, F.lit("T00:00:00.500Z")))
        .when(kind == 4, F.lit("  "))
        .otherwise(F.lit("31/12/1999"))
    )
    millis = F.unix_millis(moment.cast("timestamp")).cast("string")
    json = F.when(kind == 0, millis).otherwise(F.concat(F.lit('"'), text, F.lit('"')))
    columns = {"as_timestamp": T.TimestampType(), "as_date": T.DateType()}
    return _coerced(read(spark, sf_dir, "orders"), ["o_orderkey"], json, columns)


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN '{"k":' || o_custkey || ',"s":"é' || o_orderstatus || '"}'
    WHEN 1 THEN '[' || o_custkey || ', "' || o_orderstatus || '"]' WHEN 2 THEN o_orderpriority
    ELSE CAST(o_custkey AS VARCHAR) END AS as_text FROM orders""")
def coerce_json_text(spark, sf_dir):
    """In turn: an object, a list, a text and a number, as text."""
    kind, key = F.pmod("o_orderkey", F.lit(4)), F.col("o_custkey")
    status = F.col("o_orderstatus")
    json = (
        F.when(kind == 0, F.concat(F.lit('{"s": "é'), status, F.lit('", "k": '), key, F.lit("}")))
        .when(kind == 1, F.concat(F.lit("["), key, F.lit(',"'), status, F.lit('"]')))
        .when(kind == 2, F.concat(F.lit('"'), "o_orderpriority", F.lit('"')))
        .otherwise(key.cast("string"))
    )
    return _coerced(read(spark, sf_dir, "orders"), ["o_orderkey"], json, {"as_text": T.StringType()})


@query("""SELECT p_partkey, array_to_string(string_split(p_name, ' '), '|') AS tags,
    CASE p_partkey % 3 WHEN 0 THEN NULL ELSE p_size + p_partkey END AS total FROM part""")
def coerce_arrays(spark, sf_dir):
    """Lists as a JSON list, as text holding one, and as text holding a list of such text."""
    kind = F.pmod("p_partkey", F.lit(3))
    words = F.to_json(F.split("p_name", " "))
    numbers = F.concat(F.lit("["), "p_size", F.lit(","), "p_partkey", F.lit("]"))

    def shaped(listed: Column) -> Column:
        once, twice = _quoted(listed), _quoted(F.to_json(F.array(listed)))
        return F.when(kind == 0, listed).when(kind == 1, once).otherwise(twice)

    # Where a list of numbers comes as a bare text, it is no list and becomes NULL.
    shaped_numbers = F.when(kind == 0, _quoted(F.lit("no list"))).otherwise(shaped(numbers))
    parsed = read(spark, sf_dir, "part").select(
        "p_partkey", F.parse_json(shaped(words)).alias("w"), F.parse_json(shaped_numbers).alias("n")
    )
    lists = coerce_columns(
        parsed,
        {"w": (F.col("w"), T.ArrayType(T.StringType())), "n": (F.col("n"), T.ArrayType(T.LongType()))},
        keep=("p_partkey",),
    )
    total = F.aggregate("n", F.lit(0).cast("bigint"), lambda a, x: a + x)
    return lists.select("p_partkey", F.array_join("w", "|").alias("tags"), total.alias("total"))


def _quoted(text: Column) -> Column:
    """A JSON string literal with the given text."""
    as_list = F.to_json(F.array(text))
    return F.substring(as_list, F.lit(2), F.length(as_list) - 2)


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 3 THEN NULL ELSE 'customer_' || o_custkey END AS customer
    FROM orders""")
def relation_to_id(spark, sf_dir):
    """In turn: an object with externalId, one with external_id, the text form of a relation, and no relation."""
    kind, ref = F.pmod("o_orderkey", F.lit(4)), F.concat(F.lit("customer_"), "o_custkey")
    json = (
        F.when(kind == 0, F.concat(F.lit('{"space": "people", "externalId": "'), ref, F.lit('"}')))
        .when(kind == 1, F.concat(F.lit('{"external_id": "'), ref, F.lit('"}')))
        .when(kind == 2, F.concat(F.lit('"{space=people, externalId='), ref, F.lit('}"')))
        .otherwise(F.lit('{"space": "people"}'))
    )
    parsed = read(spark, sf_dir, "orders").select("o_orderkey", F.parse_json(json).alias("v"))
    return parsed.select("o_orderkey", relation_id(F.col("v")).alias("customer"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, '["part_' || l_partkey || '", "supplier_' || l_suppkey || '"'
    || CASE WHEN l_partkey % 8 = 0 THEN ', ' || l_linenumber ELSE '' END || ']' AS as_text,
    'part_' || l_partkey || '|supplier_' || l_suppkey
    || CASE WHEN l_partkey % 8 = 0 THEN '|' || l_linenumber ELSE '' END AS as_list FROM lineitem""")
def relation_list_to_ids(spark, sf_dir):
    """Lists of two relations; every eighth part has one of them as text, and a number after them."""
    part = F.concat(F.lit('[{"space": "s", "externalId": "part_'), "l_partkey", F.lit('"}, '))
    pair = F.concat(part, F.lit('{"space": "s", "externalId": "supplier_'), "l_suppkey", F.lit('"}]'))
    mixed = F.concat(
        part, F.lit('"{space=s, externalId=supplier_'), "l_suppkey", F.lit('}", '), "l_linenumber", F.lit("]")
    )
    json = F.when(F.pmod("l_partkey", F.lit(8)) == 0, mixed).otherwise(pair)
    columns = {"as_text": T.StringType(), "as_list": T.ArrayType(T.StringType())}
    rows = _coerced(read(spark, sf_dir, "lineitem"), LINE_KEYS, json, columns)
    return rows.withColumn("as_list", F.array_join("as_list", "|"))


# Series payloads


@query(f"""SELECT date_trunc('millisecond', ts) AS timestamp,
    CASE WHEN space IN ('click', 'view', 'error') THEN value END AS value,
    CASE WHEN space NOT IN ('click', 'view', 'error') THEN status_symbol END AS value_string,
    CASE WHEN space <> 'error' THEN status_code END AS status_code,
    CASE WHEN space <> 'error' THEN status_symbol END AS status_symbol,
    external_id, space FROM {POINTS_SQL}""")
def payload_unnest(spark, sf_dir):
    """Payloads of one series and hour each: numbers for two spaces, averages for one, texts for the others."""
    table = points(spark, sf_dir)
    status = F.struct(F.col("status_code").alias("code"), F.col("status_symbol").alias("symbol"))
    millis = F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp")
    held = F.col("space").isin("click", "view")
    rolled = F.col("space") == "error"
    numeric = F.when(held, F.struct(millis, "value", status.alias("status")))
    string = F.when(~held & ~rolled, F.struct(millis, F.col("status_symbol").alias("value"), status.alias("status")))
    average = F.when(rolled, F.struct(millis, F.col("value").alias("average")))
    grouped = table.groupBy("space", "external_id", F.date_trunc("hour", "ts").alias("hour")).agg(
        F.collect_list(numeric).alias("n"), F.collect_list(string).alias("s"), F.collect_list(average).alias("a")
    )
    points_of = lambda c: F.when(F.size(c) > 0, F.struct(F.col(c).alias("datapoints")))
    item = F.struct(
        F.struct("space", F.col("external_id").alias("externalId")).alias("instanceId"),
        points_of("n").alias("numericDatapoints"),
        points_of("s").alias("stringDatapoints"),
        points_of("a").alias("aggregateDatapoints"),
    )
    payload = F.to_json(F.struct(F.array(item).alias("items"))).alias("payload")
    return unnest_payloads(grouped.select(payload))


# Id and time text


@query("""SELECT event_id, event_type AS space, 'user:' || user_id || ':x' AS external_id FROM events
    WHERE event_id % 3 <> 0 UNION ALL SELECT event_id, NULL, NULL FROM events WHERE event_id % 3 = 0""")
def parse_instance_id(spark, sf_dir):
    """Ids with blanks and further colons; every third one lacks its colon and is no id."""
    good = F.concat(F.lit(" "), "event_type", F.lit(" : user:"), "user_id", F.lit(":x "))
    text = F.when(F.col("event_id") % 3 != 0, good).otherwise(F.col("event_type"))
    parsed = read(spark, sf_dir, "events").select("event_id", instance_id_struct(text).alias("id"))
    return parsed.select("event_id", "id.space", "id.external_id")


@query("""SELECT event_id, event_type AS space, 'user_' || user_id AS external_id FROM events
    UNION ALL SELECT event_id, 'other', 'a:b' FROM events""")
def parse_instance_ids(spark, sf_dir):
    text = F.concat("event_type", F.lit(":user_"), "user_id", F.lit(" , ,other:a:b,"))
    parsed = read(spark, sf_dir, "events").select("event_id", F.inline(instance_id_array(text)))
    return parsed.select("event_id", "space", "external_id")


@query("""SELECT event_id, CASE event_id % 7 WHEN 0 THEN TIMESTAMP '2024-01-31 00:00:00'
    WHEN 1 THEN TIMESTAMP '2024-01-31 00:00:00' - to_hours(user_id)
    WHEN 2 THEN TIMESTAMP '2024-01-31 00:00:00' + to_days(7 * CAST(user_id AS INTEGER))
    WHEN 3 THEN date_trunc('second', ts) WHEN 4 THEN date_trunc('millisecond', ts)
    WHEN 5 THEN date_trunc('millisecond', ts) END AS moment FROM events""")
def time_literals(spark, sf_dir):
    """In turn: now, hours ago, weeks ahead, ISO with Z, SQL text with a fraction, epoch milliseconds, and junk."""
    kind, user, ts = F.pmod("event_id", F.lit(7)), F.col("user_id"), F.col("ts")
    text = (
        F.when(kind == 0, "NOW")
        .when(kind == 1, F.concat(user, F.lit("h-ago")))
        .when(kind == 2, F.concat(user, F.lit("w-ahead")))
        .when(kind == 3, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(kind == 4, F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .when(kind == 5, F.unix_millis(ts.cast("timestamp")).cast("string"))
        .otherwise(F.concat(user, F.lit("w-agoXYZ")))
    )
    now = F.lit("2024-01-31 00:00:00").cast("timestamp")
    return read(spark, sf_dir, "events").select("event_id", resolve_time_column(text, now).alias("moment"))
