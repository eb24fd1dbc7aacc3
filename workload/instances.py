"""Queries over view tables: scans, filters, limits, sorts, joins and instance aggregates."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import functions as F

from viewloom.operators.aggregates import Metric, aggregate, as_view_rows, grouped_counts, long_form
from viewloom.operators.filters import FilterSpec
from viewloom.operators.joins import join_on_instance, join_on_property, join_on_reference
from viewloom.model import Property, ViewDef
from viewloom.operators.scan import conform, scan
from workload.registry import registrar
from workload.tables import (
    CUSTOMERS_SQL,
    ORDER_VIEW,
    ORDERS_SQL,
    PART_VIEW,
    PARTS_SQL,
    customers,
    orders,
    parts,
    read,
)

QUERIES = {}
ORACLES = {}

COUNT = Metric("count", "externalId")


query = registrar(QUERIES, ORACLES)


# Scans and projections


@query(f"SELECT * FROM {ORDERS_SQL}")
def view_scan(spark, sf_dir):
    return scan(orders(spark, sf_dir), ORDER_VIEW)


@query(f'SELECT external_id, "totalPrice" AS price, class_ AS priority FROM {ORDERS_SQL}')
def project_columns(spark, sf_dir):
    wanted = ["external_id", F.col("totalPrice").alias("price"), F.col("class_").alias("priority")]
    return scan(orders(spark, sf_dir), ORDER_VIEW, columns=wanted)


# Filters


@query(f"""SELECT external_id, class_ FROM {ORDERS_SQL} WHERE class_ = '2-HIGH'""")
def filter_equals(spark, sf_dir):
    return scan(
        orders(spark, sf_dir), ORDER_VIEW, FilterSpec(equals={"class": "2-HIGH"}), ["external_id", "class_"]
    )


@query(f"""SELECT external_id, class_ FROM {ORDERS_SQL} WHERE class_ IN ('1-URGENT', '2-HIGH')""")
def filter_in(spark, sf_dir):
    spec = FilterSpec(equals={"class": '["1-URGENT", "2-HIGH"]'})
    return scan(orders(spark, sf_dir), ORDER_VIEW, spec, ["external_id", "class_"])


@query(f"""SELECT external_id, array_to_string(tags, ' ') AS tags FROM {PARTS_SQL}
    WHERE list_has_any(tags, ['red', 'bolt'])""")
def filter_contains_any(spark, sf_dir):
    spec = FilterSpec(equals={"tags": ["red", "bolt"]})
    return scan(parts(spark, sf_dir), PART_VIEW, spec, ["external_id", F.array_join("tags", " ").alias("tags")])


@query(f"""SELECT external_id, "shipNote" FROM {ORDERS_SQL} WHERE "shipNote" IS NOT NULL AND clerk IS NOT NULL""")
def filter_exists(spark, sf_dir):
    spec = FilterSpec(exists=["shipNote", "clerk"])
    return scan(orders(spark, sf_dir), ORDER_VIEW, spec, ["external_id", "shipNote"])


@query(f"""SELECT external_id, "totalPrice" FROM {ORDERS_SQL} WHERE "shipNote" IS NULL""")
def filter_not_exists(spark, sf_dir):
    spec = FilterSpec(not_exists="shipNote")
    return scan(orders(spark, sf_dir), ORDER_VIEW, spec, ["external_id", "totalPrice"])


@query(f"SELECT space, external_id FROM {ORDERS_SQL} WHERE space IN ('O', 'P')")
def filter_space(spark, sf_dir):
    return scan(orders(spark, sf_dir), ORDER_VIEW, FilterSpec(instance_space=["O", "P"]), ["space", "external_id"])


@query(f"""SELECT external_id, "totalPrice" FROM {ORDERS_SQL}
    WHERE external_id IN ('order_1', 'order_77', 'order_500', 'no_such_order')""")
def filter_external_id(spark, sf_dir):
    spec = FilterSpec(external_id='["order_1", "order_77", "order_500", "no_such_order"]')
    return scan(orders(spark, sf_dir), ORDER_VIEW, spec, ["external_id", "totalPrice"])


@query(f"""SELECT external_id, "totalPrice", clerk FROM {ORDERS_SQL}
    WHERE "totalPrice" > 100000 AND "totalPrice" <= 250000.5 AND clerk >= 10 AND clerk < 30""")
def filter_range(spark, sf_dir):
    spec = FilterSpec(
        gt={"totalPrice": 100000, "clerk": None}, lte={"totalPrice": 250000.5}, gte='{"clerk": 10}', lt={"clerk": 30}
    )
    return scan(orders(spark, sf_dir), ORDER_VIEW, spec, ["external_id", "totalPrice", "clerk"])


@query(f"""SELECT external_id, space, class_, "totalPrice" FROM {ORDERS_SQL}
    WHERE class_ IN ('1-URGENT', '5-LOW') AND customer IS NOT NULL AND "shipNote" IS NULL
      AND space = 'F' AND "totalPrice" >= 50000""")
def filter_conjunction(spark, sf_dir):
    spec = FilterSpec(
        equals={"class": ["1-URGENT", "5-LOW"], "status": None},
        exists="customer",
        not_exists=["shipNote"],
        instance_space=["F"],
        gte={"totalPrice": 50000},
    )
    return scan(orders(spark, sf_dir), ORDER_VIEW, spec, ["external_id", "space", "class_", "totalPrice"])


@query(f"""SELECT external_id, "orderDate" FROM {ORDERS_SQL}
    WHERE "orderDate" >= TIMESTAMP '1997-01-01 00:00:00' AND "orderDate" < TIMESTAMP '1998-07-01 00:00:00'""")
def filter_timestamp_range(spark, sf_dir):
    spec = FilterSpec(
        gte={"orderDate": date(1997, 1, 1)}, lt={"orderDate": datetime(1998, 7, 1, tzinfo=timezone.utc)}
    )
    return scan(orders(spark, sf_dir), ORDER_VIEW, spec, ["external_id", "orderDate"])


# Limits and sorts


@query("""SELECT '25' AS asked, CAST(25 AS BIGINT) AS got UNION ALL SELECT '0', 0
    UNION ALL SELECT '-1', count(*) FROM orders""")
def row_limit(spark, sf_dir):
    table = orders(spark, sf_dir)
    counted = [
        scan(table, ORDER_VIEW, limit=asked).agg(F.lit(asked).alias("asked"), F.count(F.lit(1)).alias("got"))
        for asked in ("25", "0", "-1")
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@query(f'SELECT external_id, class_, "totalPrice" FROM {ORDERS_SQL} ORDER BY class_, "totalPrice" DESC, external_id')
def order_by(spark, sf_dir):
    return scan(orders(spark, sf_dir), ORDER_VIEW, columns=["external_id", "class_", "totalPrice"]).orderBy(
        "class_", F.desc("totalPrice"), "external_id"
    )


@query(f"""SELECT external_id, "totalPrice" FROM {ORDERS_SQL} ORDER BY "totalPrice" DESC, external_id LIMIT 100""")
def top_k(spark, sf_dir):
    rows = scan(orders(spark, sf_dir), ORDER_VIEW, columns=["external_id", "totalPrice"])
    return rows.orderBy(F.desc("totalPrice"), "external_id").limit(100)


# Edges: orders and their lines in one table of nodes and edges

LINE_VIEW = ViewDef("sales", "LineView", "v1", (Property("quantity", "float64"), Property("flag")), used_for="edge")


@query("""SELECT CAST(l_quantity AS DOUBLE) AS quantity, l_returnflag AS flag, 'lines' AS space,
    'order_' || l_orderkey || '_' || l_linenumber AS external_id, CAST(NULL AS TIMESTAMP) AS "createdTime",
    CAST(NULL AS TIMESTAMP) AS "lastUpdatedTime", CAST(NULL AS TIMESTAMP) AS "deletedTime" FROM lineitem""")
def edge_view(spark, sf_dir):
    edges = read(spark, sf_dir, "lineitem").select(
        F.lit("edge").alias("instance_type"), F.col("l_quantity").alias("quantity"), F.col("l_returnflag").alias("flag"),
        F.lit("lines").alias("space"), F.concat(F.lit("order_"), "l_orderkey", F.lit("_"), "l_linenumber").alias("external_id"),
    )
    nodes = read(spark, sf_dir, "orders").select(
        F.lit("node").alias("instance_type"), F.col("o_totalprice").alias("quantity"), F.col("o_orderstatus").alias("flag"),
        F.lit("lines").alias("space"), F.concat(F.lit("order_"), "o_orderkey").alias("external_id"),
    )
    return scan(conform(edges.unionByName(nodes), LINE_VIEW), LINE_VIEW)


# Joins


@query(f"""SELECT c.external_id AS customer, c.segment, o.external_id AS order_id, o."totalPrice" AS price
    FROM {CUSTOMERS_SQL} c JOIN {ORDERS_SQL} o ON c.external_id = o.customer""")
def join_external_id(spark, sf_dir):
    joined = join_on_reference(customers(spark, sf_dir), orders(spark, sf_dir), "customer")
    return joined.select(
        F.col("l.external_id").alias("customer"),
        F.col("l.segment"),
        F.col("r.external_id").alias("order_id"),
        F.col("r.totalPrice").alias("price"),
    )


@query(f"""SELECT c.space, c.external_id AS customer, o.o_orderkey AS order_key
    FROM {CUSTOMERS_SQL} c JOIN (SELECT 'shard_' || (o_orderkey % 4) AS space, 'customer_' || o_custkey AS customer,
    o_orderkey FROM orders) o ON c.space = o.space AND c.external_id = o.customer""")
def join_space_external_id(spark, sf_dir):
    children = read(spark, sf_dir, "orders").select(
        F.concat(F.lit("shard_"), F.pmod("o_orderkey", F.lit(4))).alias("space"),
        F.concat(F.lit("customer_"), "o_custkey").alias("customer"),
        "o_orderkey",
    )
    joined = join_on_instance(customers(spark, sf_dir), children, "customer")
    return joined.select(
        F.col("l.space"), F.col("l.external_id").alias("customer"), F.col("r.o_orderkey").alias("order_key")
    )


@query(f"""SELECT c.external_id AS customer, n.n_name AS nation_name FROM {CUSTOMERS_SQL} c
    JOIN nation n ON c.nation = n.n_nationkey""")
def join_property(spark, sf_dir):
    nations = read(spark, sf_dir, "nation").select("n_name", F.col("n_nationkey").cast("string").alias("code"))
    joined = join_on_property(customers(spark, sf_dir), nations, "nation", "code")
    return joined.select(F.col("l.external_id").alias("customer"), F.col("r.n_name").alias("nation_name"))


# Aggregates


@query('SELECT count(*) AS "count_externalId" FROM orders')
def agg_count(spark, sf_dir):
    return aggregate(orders(spark, sf_dir), ORDER_VIEW, [COUNT])


@query(f'SELECT count("shipNote") AS "count_shipNote" FROM {ORDERS_SQL}')
def agg_count_property(spark, sf_dir):
    return aggregate(orders(spark, sf_dir), ORDER_VIEW, '[{"fn": "count", "property": "shipNote"}]')


@query("""SELECT min(o_totalprice) AS "min_totalPrice", max(o_totalprice) AS "max_totalPrice" FROM orders""")
def agg_min_max(spark, sf_dir):
    return aggregate(orders(spark, sf_dir), ORDER_VIEW, [Metric("min", "totalPrice"), Metric("max", "totalPrice")])


@query(f"""SELECT count(*) AS "count_externalId", count(clerk) AS count_clerk, min(clerk) AS min_clerk,
    max(clerk) AS max_clerk, max("totalPrice") AS dearest FROM {ORDERS_SQL}""")
def agg_multi(spark, sf_dir):
    metrics = [
        COUNT,
        Metric("count", "clerk"),
        Metric("min", "clerk"),
        Metric("max", "clerk"),
        Metric("max", "totalPrice", "dearest"),
    ]
    return aggregate(orders(spark, sf_dir), ORDER_VIEW, metrics)


@query(f"""SELECT count(*) AS "count_externalId", min("totalPrice") AS "min_totalPrice" FROM {ORDERS_SQL}
    WHERE class_ = '1-URGENT' AND "shipNote" IS NOT NULL AND "totalPrice" > 200000""")
def agg_filtered(spark, sf_dir):
    spec = FilterSpec(equals={"class": "1-URGENT"}, exists="shipNote", gt={"totalPrice": 200000})
    return aggregate(orders(spark, sf_dir), ORDER_VIEW, [COUNT, Metric("min", "totalPrice")], spec=spec)


@query("SELECT o_orderpriority AS class_, count(*) AS count FROM orders GROUP BY 1")
def group_by_property(spark, sf_dir):
    return grouped_counts(orders(spark, sf_dir), ORDER_VIEW, ["class"])


@query(f"""SELECT space, class_, count(*) AS "count_externalId", max("totalPrice") AS "max_totalPrice"
    FROM {ORDERS_SQL} GROUP BY space, class_""")
def group_by_space(spark, sf_dir):
    return aggregate(
        orders(spark, sf_dir), ORDER_VIEW, [COUNT, Metric("max", "totalPrice")], group_by='["space", "class"]'
    )


@query(f"""SELECT external_id, count(*) AS "count_externalId", max("totalPrice") AS "max_totalPrice"
    FROM {ORDERS_SQL} GROUP BY external_id""")
def group_by_external_id(spark, sf_dir):
    return aggregate(orders(spark, sf_dir), ORDER_VIEW, [COUNT, Metric("max", "totalPrice")], group_by=["externalId"])


@query(f"""SELECT customer, count(*) AS "count_externalId" FROM {ORDERS_SQL} GROUP BY customer
    ORDER BY customer LIMIT 1000""")
def group_cap(spark, sf_dir):
    return aggregate(orders(spark, sf_dir), ORDER_VIEW, [COUNT], ["customer"], max_groups=1000)


@query(f"""SELECT CAST(NULL AS VARCHAR) AS status, max("totalPrice") AS "totalPrice",
    CAST(NULL AS TIMESTAMP) AS "orderDate", class_, CAST(NULL AS VARCHAR) AS customer,
    CAST(NULL AS VARCHAR) AS "shipNote", CAST(NULL AS BIGINT) AS clerk, space,
    CAST(count(*) AS VARCHAR) AS external_id, CAST(NULL AS TIMESTAMP) AS "createdTime",
    CAST(NULL AS TIMESTAMP) AS "lastUpdatedTime", CAST(NULL AS TIMESTAMP) AS "deletedTime"
    FROM {ORDERS_SQL} GROUP BY class_, space""")
def agg_view_layout(spark, sf_dir):
    metrics, keys = [COUNT, Metric("max", "totalPrice")], ["class", "space"]
    return as_view_rows(aggregate(orders(spark, sf_dir), ORDER_VIEW, metrics, keys), ORDER_VIEW, metrics, keys)


@query(f"""WITH a AS (SELECT class_, count(*) AS n, min("totalPrice") AS lo, max("totalPrice") AS hi
      FROM {ORDERS_SQL} GROUP BY class_)
    SELECT class_, 'count' AS aggregate, 'externalId' AS property, CAST(n AS DOUBLE) AS value FROM a
    UNION ALL SELECT class_, 'min', 'totalPrice', lo FROM a UNION ALL SELECT class_, 'max', 'totalPrice', hi FROM a""")
def agg_long_form(spark, sf_dir):
    metrics = [COUNT, Metric("min", "totalPrice"), Metric("max", "totalPrice")]
    return long_form(aggregate(orders(spark, sf_dir), ORDER_VIEW, metrics, ["class"]), metrics)
