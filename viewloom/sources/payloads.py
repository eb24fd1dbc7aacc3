"""Time-series payloads: ``{"items": [...]}`` where each item holds the points of one series.

An item has exactly one of ``numericDatapoints``, ``stringDatapoints`` and ``aggregateDatapoints``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATUS = "status STRUCT<code: INT, symbol: STRING>"
# The aggregate fields of a payload, by lower-case aggregate name.
AGGREGATE_FIELDS = {
    "average": "average",
    "max": "max",
    "min": "min",
    "count": "count",
    "sum": "sum",
    "interpolation": "interpolation",
    "stepinterpolation": "stepInterpolation",
    "continuousvariance": "continuousVariance",
    "discretevariance": "discreteVariance",
    "totalvariation": "totalVariation",
    "countgood": "countGood",
    "countuncertain": "countUncertain",
    "countbad": "countBad",
    "durationgood": "durationGood",
    "durationuncertain": "durationUncertain",
    "durationbad": "durationBad",
}
# The fields of a payload that hold a whole point.
POINT_FIELDS = {"mindatapoint": "minDatapoint", "maxdatapoint": "maxDatapoint"}
POINT = f"STRUCT<timestamp: BIGINT, value: DOUBLE, {STATUS}>"
PAYLOAD_SCHEMA = f"""items ARRAY<STRUCT<
    instanceId: STRUCT<space: STRING, externalId: STRING>,
    numericDatapoints: STRUCT<datapoints: ARRAY<STRUCT<timestamp: BIGINT, value: DOUBLE, {STATUS}>>>,
    stringDatapoints: STRUCT<datapoints: ARRAY<STRUCT<timestamp: BIGINT, value: STRING, {STATUS}>>>,
    aggregateDatapoints: STRUCT<datapoints: ARRAY<STRUCT<timestamp: BIGINT,
        {', '.join(f'{field}: DOUBLE' for field in AGGREGATE_FIELDS.values())},
        {', '.join(f'{field}: {POINT}' for field in POINT_FIELDS.values())}>>>
>>"""


def unnest_payloads(payloads: DataFrame, payload: str = "payload", aggregate: str | None = None) -> DataFrame:
    """One row per point: space, external_id, timestamp, value, value_string, status_code, status_symbol.

    Aggregate points have no status and give the field named by ``aggregate``; the least and the greatest point of a
    bucket (``minDatapoint``, ``maxDatapoint``) come with their own time and status, or without value where the payload
    has none. A missing series identity becomes empty text.
    """
    name = (aggregate or "average").lower()
    field = AGGREGATE_FIELDS.get(name) or POINT_FIELDS.get(name)
    if field is None:
        raise ValueError(f"unknown aggregate {aggregate!r}")
    item = payloads.select(F.explode(F.from_json(F.col(payload), PAYLOAD_SCHEMA)["items"]).alias("item"))
    none = F.lit(None)

    def point(p, value, value_string, code, symbol):
        return F.struct(
            F.timestamp_millis(p["timestamp"]).alias("timestamp"),
            value.cast("double").alias("value"),
            value_string.cast("string").alias("value_string"),
            code.cast("int").alias("status_code"),
            symbol.cast("string").alias("status_symbol"),
        )

    status = lambda p, name: p["status"][name]
    numeric = F.transform(
        F.col("item.numericDatapoints.datapoints"),
        lambda p: point(p, p["value"], none, status(p, "code"), status(p, "symbol")),
    )
    string = F.transform(
        F.col("item.stringDatapoints.datapoints"),
        lambda p: point(p, none, p["value"], status(p, "code"), status(p, "symbol")),
    )

    def rolled_up(p):
        if name not in POINT_FIELDS:
            return point(p, p[field], none, none, none)
        held = point(p[field], p[field]["value"], none, status(p[field], "code"), status(p[field], "symbol"))
        return F.when(p[field].isNotNull(), held).otherwise(point(p, none, none, none, none))

    rolled = F.transform(F.col("item.aggregateDatapoints.datapoints"), rolled_up)
    rows = item.select(
        F.coalesce(F.col("item.instanceId.space"), F.lit("")).alias("space"),
        F.coalesce(F.col("item.instanceId.externalId"), F.lit("")).alias("external_id"),
        F.explode(
            F.when(F.size(numeric) > 0, numeric).when(F.size(string) > 0, string).otherwise(rolled)
        ).alias("p"),
    )
    return rows.select("p.timestamp", "p.value", "p.value_string", "p.status_code", "p.status_symbol",
                       "external_id", "space")
