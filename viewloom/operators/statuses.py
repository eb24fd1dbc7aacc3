"""What points' statuses add up to per time bucket, and the extreme points of each bucket.

A point is good, uncertain or bad by the beginning of its status symbol; one without a symbol is good. Its status lasts
until the next point of its series, or to the end of the range, and is cut where a bucket ends; before the first point
of the range a series has no status. As everywhere, no step brings a whole series to one task: the next point is looked
for inside stretches of an hour, whose ends are joined up from one row for each stretch.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from viewloom.functions.identity import parse_instance_ids
from viewloom.functions.timing import TimeArgument, granularity_seconds, resolve_time
from viewloom.operators.datapoints import Ids, _now, complete, in_range, only_series
from viewloom.operators.rollups import GRID_BUCKETS, MICROS, SERIES, STRETCH, floor_to, instant, micros

# The three kinds of status.
STATUSES = ("good", "uncertain", "bad")


def status_of(symbol: Column) -> Column:
    lowered = F.lower(F.trim(symbol))
    return F.when(lowered.startswith("bad"), "bad").when(lowered.startswith("uncertain"), "uncertain").otherwise("good")


def _points(table: DataFrame, instance_ids: Ids, first: datetime, last: datetime) -> DataFrame:
    ids = None if instance_ids is None else parse_instance_ids(instance_ids)
    points = in_range(only_series(complete(table), ids), first, last)
    at = F.unix_micros(F.col("ts").cast("timestamp")).alias("at")
    return points.select(*SERIES, at, "value", "status_code", status_of(F.col("status_symbol")).alias("status"))


def spans(points: DataFrame, end: int) -> DataFrame:
    """(space, external_id, at, status, until): each point with the time up to which its status lasts."""
    keys = [*SERIES, "stretch"]
    placed = points.select(*SERIES, "at", "status", floor_to(F.col("at"), STRETCH).alias("stretch"))
    inside = placed.withColumn("next_at", F.lead("at").over(Window.partitionBy(*keys).orderBy("at")))
    across = Window.partitionBy(*SERIES).orderBy("stretch")
    starts = placed.groupBy(*keys).agg(F.min("at").alias("first_at"))
    following = starts.select(*keys, F.lead("first_at").over(across).alias("later_at"))
    until = F.coalesce("next_at", "later_at", F.lit(end).cast("bigint"))
    return inside.join(following, keys).select(*SERIES, "at", "status", until.alias("until"))


def _pieces(held: DataFrame, width: int) -> DataFrame:
    """`held` cut at the ends of buckets: one row for each bucket that a status reaches into, with `bucket`. Cut in blocks of
    GRID_BUCKETS first, so that no row makes an array that grows with the time it lasts."""
    block_width = width * GRID_BUCKETS
    last = F.greatest(F.col("until") - 1, F.col("at"))
    low, high = floor_to(F.col("at"), width), floor_to(last, width)
    blocks = F.sequence(floor_to(low, block_width), floor_to(high, block_width), F.lit(block_width).cast("bigint"))
    blocked = held.select("*", F.explode(blocks).alias("block"))
    inner = F.sequence(F.greatest("block", low), F.least(F.col("block") + (block_width - width), high), F.lit(width).cast("bigint"))
    return blocked.select(*held.columns, F.explode(inner).alias("bucket"))


def status_durations(
    table: DataFrame,
    instance_ids: Ids,
    start: TimeArgument = "2w-ago",
    end: TimeArgument = "now",
    granularity: str = "1d",
    now: datetime | None = None,
) -> DataFrame:
    """Per series and bucket: space, external_id, timestamp, count_good, count_uncertain, count_bad, and duration_good,
    duration_uncertain, duration_bad in milliseconds.

    Counts are of the points inside the bucket. A bucket without points has a row if a status reaches into it, none before the
    first point of the range. Points whose value is missing or text count as well.
    """
    moment = _now(now)
    first, last = resolve_time(start, moment), resolve_time(end, moment)
    width = granularity_seconds(granularity) * MICROS
    held = spans(_points(table, instance_ids, first, last), micros(last))
    cut = F.least(F.col("until"), F.col("bucket") + width) - F.greatest("at", "bucket")
    own = F.col("bucket") == floor_to(F.col("at"), width)
    pieces = _pieces(held, width).select(*SERIES, "bucket", "status", own.alias("own"), cut.alias("cut"))
    is_of = {s: F.col("status") == s for s in STATUSES}
    counts = [F.count_if(is_of[s] & F.col("own")).cast("double").alias(f"count_{s}") for s in STATUSES]
    lasted = [(F.sum(F.when(is_of[s], F.col("cut")).otherwise(0)) / 1000).alias(f"duration_{s}") for s in STATUSES]
    stamp = instant(F.col("bucket"), table.schema["ts"].dataType).alias("timestamp")
    names = [f"{part}_{s}" for part in ("count", "duration") for s in STATUSES]
    return pieces.groupBy(*SERIES, "bucket").agg(*counts, *lasted).select(*SERIES, stamp, *names)


def extreme_points(
    table: DataFrame,
    instance_ids: Ids,
    start: TimeArgument = "2w-ago",
    end: TimeArgument = "now",
    granularity: str = "1d",
    now: datetime | None = None,
) -> DataFrame:
    """The least and the greatest point of each series and bucket: space, external_id, timestamp, then min_timestamp, min_value,
    min_status_code and the same for max. Of equal values the earliest point is taken. Points without a number don't count.

    Extremes are one hash aggregate; the points that reach them are found by a join with those few rows.
    """
    moment = _now(now)
    first, last = resolve_time(start, moment), resolve_time(end, moment)
    width = granularity_seconds(granularity) * MICROS
    points = _points(table, instance_ids, first, last).where(F.col("value").isNotNull())
    placed = points.select(*SERIES, floor_to(F.col("at"), width).alias("bucket"), "at", "value", "status_code")
    keys = [*SERIES, "bucket"]
    extremes = placed.groupBy(*keys).agg(F.min("value").alias("min_value"), F.max("value").alias("max_value"))
    reached = placed.join(extremes, keys).where("value = min_value OR value = max_value")
    kind = table.schema["ts"].dataType
    columns = []
    for side in ("min", "max"):
        at = F.when(F.col("value") == F.col(f"{side}_value"), F.col("at"))
        columns += [
            F.min(at).alias(f"{side}_at"),
            F.min_by("value", at).alias(f"{side}_value"),
            F.min_by("status_code", at).alias(f"{side}_status_code"),
        ]
    found = reached.groupBy(*keys).agg(*columns)
    stamps = [instant(F.col(f"{side}_at"), kind).alias(f"{side}_timestamp") for side in ("min", "max")]
    values = [f"{side}_{c}" for side in ("min", "max") for c in ("value", "status_code")]
    return found.select(*SERIES, instant(F.col("bucket"), kind).alias("timestamp"), *stamps, *values)
