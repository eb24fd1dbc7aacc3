"""Datapoint scans: raw points, rollups and latest points of some or all series of a datapoint table.

A datapoint table has ``space, external_id, ts, value`` and may have ``value_string, status_code, status_symbol``;
(space, external_id, ts) is unique. Time ranges are half-open, [start, end). Ids that the table does not have are
ignored; ``instance_ids=None`` means every series.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from viewloom.functions.identity import InstanceId, composite_id, parse_instance_id, parse_instance_ids
from viewloom.functions.timing import TimeArgument, resolve_time, time_literal
from viewloom.operators.rollups import GRIDDED, SERIES, SQL_AGGREGATES, STRETCH, aggregate_name, floor_to, rollup

Ids = str | Iterable[str | tuple[str, str]] | None

# Up to this many ids become a predicate that the file scan sees; more become a join beside the bounds of the ids.
PREDICATE_IDS = 1000

# Fixed value: the rows one call for rollups may return in all, shared out over its series.
AGGREGATE_TOTAL = 10_000

OPTIONAL_COLUMNS = {"value_string": "string", "status_code": "int", "status_symbol": "string"}


def complete(table: DataFrame) -> DataFrame:
    """The datapoint table with every optional column, NULL where it has none."""
    missing = {c: F.lit(None).cast(t) for c, t in OPTIONAL_COLUMNS.items() if c not in table.columns}
    return table.withColumns(missing) if missing else table


def only_series(table: DataFrame, ids: list[InstanceId] | None) -> DataFrame:
    if ids is None:
        return table
    if len(ids) > PREDICATE_IDS:
        wanted = table.sparkSession.createDataFrame(ids, "space string, external_id string")
        near = F.lit(True)
        for column in SERIES:
            values = [getattr(item, column) for item in ids]
            near = near & F.col(column).between(min(values), max(values))
        return table.where(near).join(wanted, list(SERIES), "left_semi")
    by_space: dict[str, list[str]] = {}
    for item in ids:
        by_space.setdefault(item.space, []).append(item.external_id)
    keep = F.lit(False)
    for space, external_ids in by_space.items():
        keep = keep | ((F.col("space") == space) & F.col("external_id").isin(external_ids))
    return table.where(keep)


def in_range(table: DataFrame, start: datetime, end: datetime) -> DataFrame:
    kind = table.schema["ts"].dataType
    return table.where((F.col("ts") >= time_literal(start, kind)) & (F.col("ts") < time_literal(end, kind)))


def limit_per_series(rows: DataFrame, cap: int, order: str = "timestamp") -> DataFrame:
    """The first ``cap`` rows of each series.

    Rows are counted per series and hour first. Hours that lie wholly within the cap are kept as they are, and only the
    hour in which a series reaches it is ranked, so no task holds more of a series than the rows of one hour.
    """
    if cap < 1:
        raise ValueError(f"the cap must be at least 1, not {cap}")
    keys = [*SERIES, "hour"]
    timed = rows.withColumn("hour", floor_to(F.unix_micros(F.col(order).cast("timestamp")), STRETCH))
    counts = timed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(*SERIES).orderBy("hour").rowsBetween(Window.unboundedPreceding, -1)
    needed = counts.withColumn("left", cap - F.coalesce(F.sum("n").over(earlier), F.lit(0))).where("left > 0")
    whole = timed.join(needed.where("n <= left").select(*keys), keys, "left_semi")
    last = timed.join(needed.where("n > left").select(*keys, "left"), keys)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    first = last.withColumn("rank", rank).where(F.col("rank") <= F.col("left"))
    return whole.select(*rows.columns).unionByName(first.select(*rows.columns))


def _now(now: datetime | None) -> datetime:
    return now if now is not None else datetime.now(timezone.utc)


def _paired(aggregate: str | None, granularity: str | None) -> bool:
    """Whether the call asks for a rollup; giving only one of the two is an error."""
    if bool(aggregate) != bool(granularity):
        raise ValueError("aggregates and granularity go together: give both or neither")
    return bool(aggregate)


def datapoints_detailed(
    table: DataFrame,
    instance_ids: Ids,
    start: TimeArgument = "2w-ago",
    end: TimeArgument = "now",
    aggregates: str | None = None,
    granularity: str | None = None,
    now: datetime | None = None,
    total_limit: int | None = None,
) -> DataFrame:
    """Points or rollups of many series: timestamp, value, value_string, status_code, status_symbol, external_id, space.

    Text points have their value in ``value_string``; rollups have no status. ``total_limit`` is shared out evenly
    over the ids (at least one row each); without it every row is returned.
    """
    rolled = _paired(aggregates, granularity)
    if aggregates:
        aggregates = aggregate_name(aggregates)
    ids = None if instance_ids is None else parse_instance_ids(instance_ids)
    now = _now(now)
    first, last = resolve_time(start, now), resolve_time(end, now)
    every = only_series(complete(table), ids)
    points = in_range(every, first, last)
    if rolled:
        rows = rollup(every if aggregates in GRIDDED else points, aggregates, granularity, first, last).select(
            "timestamp",
            "value",
            *[F.lit(None).cast(t).alias(c) for c, t in OPTIONAL_COLUMNS.items()],
            "external_id",
            "space",
        )
    else:
        rows = points.select(F.col("ts").alias("timestamp"), "value", *OPTIONAL_COLUMNS, "external_id", "space")
    if total_limit is None:
        return rows
    if ids is None:
        raise ValueError("a total limit is shared out over a list of ids, so it needs one")
    return limit_per_series(rows, max(1, total_limit // len(ids)))


def datapoints(
    table: DataFrame,
    instance_id: str,
    start: TimeArgument = "2w-ago",
    end: TimeArgument = "now",
    aggregates: str | None = None,
    granularity: str | None = None,
    now: datetime | None = None,
) -> DataFrame:
    """Points or rollups of one series: timestamp, value."""
    wanted = [tuple(parse_instance_id(instance_id))]
    return datapoints_detailed(table, wanted, start, end, aggregates, granularity, now).select("timestamp", "value")


def series_aggregate(
    table: DataFrame,
    instance_ids: Ids,
    start_hint: TimeArgument,
    end_hint: TimeArgument,
    aggregate_hint: str,
    granularity_hint: str,
    now: datetime | None = None,
    total_limit: int | None = None,
) -> DataFrame:
    """Plain SQL aggregates of many series: timestamp, value, external_id, space. Every argument is required."""
    hints = {"start": start_hint, "end": end_hint, "aggregate": aggregate_hint, "granularity": granularity_hint}
    absent = [name for name, value in hints.items() if value is None or value == ""]
    if absent:
        raise ValueError(f"required: {', '.join(absent)}")
    name = SQL_AGGREGATES.get(str(aggregate_hint).strip().lower())
    if name is None:
        raise ValueError(f"unknown aggregate {aggregate_hint!r}; known are {', '.join(SQL_AGGREGATES)}")
    rows = datapoints_detailed(table, instance_ids, start_hint, end_hint, name, granularity_hint, now, total_limit)
    return rows.select("timestamp", "value", "external_id", "space")


def latest_by_series(table: DataFrame, before: datetime) -> DataFrame:
    """The last point strictly before a time, per series: space, external_id, timestamp, value, status_code.

    One hash aggregate, combined on the map side: a series has one point at a time, so that value and status are of one and
    the same point although each is picked by itself.
    """
    rows = complete(table)
    earlier = rows.where(F.col("ts") < time_literal(before, rows.schema["ts"].dataType))
    picked = (F.max_by(c, "ts").alias(c) for c in ("value", "status_code"))
    return earlier.groupBy(*SERIES).agg(F.max("ts").alias("timestamp"), *picked)


def _latest_columns(include_status: bool) -> list[Column | str]:
    status = F.col("status_code") if include_status else F.lit(None).cast("int")
    return ["timestamp", "value", status.alias("status_code")]


def latest_datapoints(
    table: DataFrame,
    instance_ids: Ids,
    before: TimeArgument = "now",
    include_status: bool = False,
    now: datetime | None = None,
) -> DataFrame:
    """The last point of each series: time_series_external_id (``space:external_id``), timestamp, value, status_code.

    A series without a point before the given time has no row.
    """
    ids = None if instance_ids is None else parse_instance_ids(instance_ids)
    moment = resolve_time(before if before is not None else "now", _now(now))
    rows = latest_by_series(only_series(table, ids), moment)
    key = composite_id(F.col("space"), F.col("external_id")).alias("time_series_external_id")
    return rows.select(key, *_latest_columns(include_status))


def datapoints_of(
    table: DataFrame,
    space: str,
    external_id: str,
    start: TimeArgument = "2w-ago",
    end: TimeArgument = "now",
    aggregates: str | None = None,
    granularity: str | None = None,
    now: datetime | None = None,
) -> DataFrame:
    """As :func:`datapoints`, with the identity in two arguments."""
    return datapoints(table, f"{space}:{external_id}", start, end, aggregates, granularity, now)


def latest_of_space(
    table: DataFrame,
    space: str,
    external_ids: str | Iterable[str] | None,
    before: TimeArgument = "now",
    include_status: bool = False,
    now: datetime | None = None,
) -> DataFrame:
    """As :func:`latest_datapoints` for series of one space; the id column holds the external id alone."""
    moment = resolve_time(before if before is not None else "now", _now(now))
    if external_ids is None:
        wanted = table.where(F.col("space") == space)
    else:
        names = external_ids.split(",") if isinstance(external_ids, str) else external_ids
        wanted = only_series(table, parse_instance_ids([(space, n.strip()) for n in names if n.strip()]))
    return latest_by_series(wanted, moment).select(
        F.col("external_id").alias("time_series_external_id"), *_latest_columns(include_status)
    )
