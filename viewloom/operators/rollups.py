"""Time-series rollups: the ten aggregates of a series per time bucket.

Input rows are points ``space, external_id, ts, value``; (space, external_id, ts) is unique. Bucket starts are
multiples of the bucket width since 1970-01-01 UTC. Output rows are ``space, external_id, timestamp, value``.

One series may hold a large share of all points, so no step brings a whole series to one task: plain aggregates are
combined on the map side, and the ones that need an order work inside bounded stretches of time (``STRETCH``,
``GRID_BUCKETS``) whose summaries are joined up afterwards.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from viewloom.functions.timing import EPOCH, as_utc, granularity_seconds

SERIES = ("space", "external_id")
MICROS = 1_000_000
# Longest time whose points are ordered in one task. At millisecond resolution a series has at most 3.6 million there.
STRETCH = 3600 * MICROS
# Most buckets of one series whose grid points are filled in one task.
GRID_BUCKETS = 4096

# The aggregate names, in lower case.
PLAIN = ("average", "max", "min", "count", "sum", "discretevariance")
ORDERED = ("continuousvariance", "totalvariation")
GRIDDED = ("interpolation", "stepinterpolation")
AGGREGATES = (*PLAIN, *ORDERED, *GRIDDED)

# The plain ones as SQL, from which both APIs are built.
PLAIN_SQL = {
    "average": "avg(value)",
    "max": "max(value)",
    "min": "min(value)",
    "count": "CAST(count(value) AS DOUBLE)",
    "sum": "sum(value)",
    "discretevariance": "var_pop(value)",
}

# The names accepted where only plain SQL aggregates are.
SQL_AGGREGATES = {
    "avg": "average",
    "average": "average",
    "sum": "sum",
    "min": "min",
    "max": "max",
    "count": "count",
}


def aggregate_name(name: str) -> str:
    lowered = name.strip().lower()
    if lowered not in AGGREGATES:
        raise ValueError(f"unknown aggregate {name!r}; known are {', '.join(sorted(AGGREGATES))}")
    return lowered


def micros(moment: datetime) -> int:
    delta = as_utc(moment) - EPOCH
    return (delta.days * 86400 + delta.seconds) * MICROS + delta.microseconds


def floor_to(position: Column, width: int) -> Column:
    """The multiple of ``width`` at or below an integer position; exact, also before 1970."""
    return position - F.pmod(position, F.lit(width).cast("bigint"))


def instant(position: Column, data_type: T.DataType) -> Column:
    moment = F.timestamp_micros(position)
    return moment.cast(data_type) if isinstance(data_type, T.TimestampNTZType) else moment


def positioned(points: DataFrame) -> DataFrame:
    """Points that have a value, with their time as microseconds since 1970 (``at``)."""
    spark = points.sparkSession
    if isinstance(points.schema["ts"].dataType, T.TimestampNTZType):
        zone = spark.conf.get("spark.sql.session.timeZone")
        if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
            raise ValueError(f"timestamps without a zone are read as UTC: set the session time zone to UTC, not {zone}")
    return points.where(F.col("value").isNotNull()).select(
        *SERIES, F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), "value"
    )


def rollup(
    points: DataFrame, aggregate: str, granularity: str, start: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    """One aggregate per series and bucket.

    Interpolations give a value at every bucket start in [start, end), which they need, where the series has one: the
    last point at or before and, unless stepwise, the first at or after. So for them ``points`` must not be cut to the
    range. For the other aggregates every point counts.
    """
    name = aggregate_name(aggregate)
    width = granularity_seconds(granularity) * MICROS
    placed = positioned(points)
    if name in PLAIN:
        rows = _plain(placed, name, width)
    elif name in ORDERED:
        rows = _ordered(placed, name, width)
    else:
        if start is None or end is None:
            raise ValueError(f"{name} needs a start and an end")
        rows = _gridded(placed, name, width, micros(start), micros(end))
    stamp = instant(F.col("bucket"), points.schema["ts"].dataType)
    return rows.select(*SERIES, stamp.alias("timestamp"), "value")


def bucket_counts(points: DataFrame, granularities: list[str]) -> DataFrame:
    """Points per bucket at several granularities, from one pass: coarser buckets are summed from shared fine ones."""
    from math import gcd

    widths = {g: granularity_seconds(g) * MICROS for g in granularities}
    fine = gcd(*widths.values())
    counted = (
        points.select(F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
        .groupBy(floor_to(F.col("at"), fine).alias("fine"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    targets = F.array(
        *[
            F.struct(F.lit(g).alias("granularity"), floor_to(F.col("fine"), w).alias("bucket"))
            for g, w in widths.items()
        ]
    )
    return (
        counted.select("n", F.inline(targets))
        .groupBy("granularity", "bucket")
        .agg(F.sum("n").alias("points"))
        .select(
            "granularity", instant(F.col("bucket"), points.schema["ts"].dataType).alias("timestamp"), "points"
        )
    )


def _plain(placed: DataFrame, name: str, width: int) -> DataFrame:
    bucket = floor_to(F.col("at"), width).alias("bucket")
    return placed.groupBy(*SERIES, bucket).agg(F.expr(PLAIN_SQL[name]).alias("value"))


# What the straight line from (at0, v0) to (at1, v1) adds to each running sum, as SQL. Times are microseconds. Values are
# taken from a nearby one, ``origin``: squares of large values would cancel each other's digits.
SEGMENT_SUMS = {
    "variation": "abs({v1} - {v0})",
    "seconds": f"(({{at1}} - {{at0}}) / {MICROS})",
    "area": f"(({{v0}} - {{origin}}) + ({{v1}} - {{origin}})) / 2 * (({{at1}} - {{at0}}) / {MICROS})",
    "square": "(({v0} - {origin}) * ({v0} - {origin}) + ({v0} - {origin}) * ({v1} - {origin}) + ({v1} - {origin}) * ({v1} - {origin}))"
    f" / 3 * (({{at1}} - {{at0}}) / {MICROS})",
}
# The sums of a stretch, whose values were taken from its first one, seen from the first value of its bucket.
MOVED_SUMS = {
    "variation": "variation",
    "seconds": "seconds",
    "area": "area + seconds * (first_value - origin)",
    "square": "square + 2 * (first_value - origin) * area + seconds * (first_value - origin) * (first_value - origin)",
}
# The result of a bucket from its sums: of one point there is no variance.
ORDERED_RESULTS = {
    "totalvariation": "variation",
    "continuousvariance": "CASE WHEN points > 1 THEN greatest(square / seconds - (area / seconds) * (area / seconds), 0D) END",
}


def ordered_sums(inside: str, across: str) -> tuple[list[str], list[str], list[str]]:
    """Select lists of the three steps from points to the sums of a bucket, as SQL.

    Points get their predecessor and the first value in the window ``inside`` (one stretch); a stretch is summed; a
    bucket's stretches, in the window ``across``, get the line from one to the next and are summed.
    """
    steps = [f"lag(at) OVER {inside} AS at0", f"lag(value) OVER {inside} AS v0", f"first(value) OVER {inside} AS start_value"]
    line = dict(at0="at0", v0="v0", at1="at", v1="value", origin="start_value")
    stretch = [f"coalesce(sum({e.format(**line)}), 0D) AS {n}" for n, e in SEGMENT_SUMS.items()]
    stretch += ["count(1) AS points", "min(at) AS first_at", "min_by(value, at) AS first_value", "max(at) AS last_at", "max_by(value, at) AS last_value"]
    joins = [f"lag(last_at) OVER {across} AS at0", f"lag(last_value) OVER {across} AS v0", f"first(first_value) OVER {across} AS origin"]
    return steps, stretch, joins


def bucket_sums() -> list[str]:
    line = dict(at0="at0", v0="v0", at1="first_at", v1="first_value", origin="origin")
    return [f"sum({MOVED_SUMS[n]} + coalesce({e.format(**line)}, 0D)) AS {n}" for n, e in SEGMENT_SUMS.items()] + ["sum(points) AS points"]


def _ordered(placed: DataFrame, name: str, width: int) -> DataFrame:
    """Sums over the line segments between neighbouring points of a bucket.

    Points are ordered inside (bucket, stretch). If a bucket is longer than a stretch, the segments that join one
    stretch to the next come from the stretches' first and last points. Sums that ``name`` doesn't need are pruned.
    """
    keys = [*SERIES, "bucket"]
    key = ", ".join(keys)
    stretches = placed.withColumns(
        {"bucket": floor_to(F.col("at"), width), "stretch": floor_to(F.col("at"), min(width, STRETCH))}
    )
    steps, stretch, joins = ordered_sums(f"(PARTITION BY {key}, stretch ORDER BY at)", f"(PARTITION BY {key} ORDER BY stretch)")
    summary = stretches.selectExpr("*", *steps).groupBy(*keys, "stretch").agg(*map(F.expr, stretch))
    if width > STRETCH:
        summary = summary.selectExpr("*", *joins).groupBy(*keys).agg(*map(F.expr, bucket_sums()))
    return summary.select(*keys, F.expr(ORDERED_RESULTS[name]).alias("value"))


def _gridded(placed: DataFrame, name: str, width: int, start: int, end: int) -> DataFrame:
    """The value at every bucket start in [start, end), from the points around it.

    Of each bucket only the first and last point can be a neighbour of a bucket start, so the points shrink to those
    first. Grid and edge points are then ordered inside blocks of ``GRID_BUCKETS`` buckets; the nearest points
    outside a block come from a pass over one summary row per block. The last point before ``start`` and the first at
    or after ``end`` count as a block before the first and one after the last.
    """
    block_width = width * GRID_BUCKETS
    first, last = -(-start // width) * width, -(-end // width) * width - width
    low, high = start // block_width * block_width, max(last, start) // block_width * block_width
    keys = [*SERIES, "block"]
    edges = (
        placed.where((F.col("at") >= start) & (F.col("at") < end))
        .groupBy(*SERIES, floor_to(F.col("at"), block_width).alias("block"), floor_to(F.col("at"), width).alias("b"))
        .agg(
            F.min("at").alias("first_at"),
            F.min_by("value", "at").alias("first_value"),
            F.max("at").alias("last_at"),
            F.max_by("value", "at").alias("last_value"),
        )
    )
    held = edges.groupBy(*keys).agg(
        F.min("first_at").alias("first_at"),
        F.min_by("first_value", "first_at").alias("first_value"),
        F.max("last_at").alias("last_at"),
        F.max_by("last_value", "last_at").alias("last_value"),
    )
    around = [(F.col("at") < start, "max", low - block_width)]
    if name == "interpolation":
        around.append((F.col("at") >= end, "min", high + block_width))
    for side, pick, block in around:
        moment, value = F.expr(f"{pick}(at)"), F.expr(f"{pick}_by(value, at)")
        nearest = placed.where(side).groupBy(*SERIES).agg(moment.alias("first_at"), value.alias("first_value"))
        held = held.unionByName(
            nearest.select(
                *SERIES, F.lit(block).cast("bigint").alias("block"), "first_at", "first_value",
                F.col("first_at").alias("last_at"), F.col("first_value").alias("last_value"),
            )
        )
    blocks = F.sequence(*[F.lit(n).cast("bigint") for n in (low, high, block_width)])
    wanted = held.select(*SERIES).distinct().select(*SERIES, F.explode(blocks).alias("block"))
    # Rows of ``wanted`` look at the rows of ``held`` strictly before and after their own block.
    both = wanted.withColumn("is_mark", F.lit(True)).unionByName(
        held.withColumn("is_mark", F.lit(False)), allowMissingColumns=True
    )
    before = Window.partitionBy(*SERIES).orderBy("block").rangeBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*SERIES).orderBy(F.desc("block")).rangeBetween(Window.unboundedPreceding, -1)
    carried = both.withColumns(
        {
            "at0": F.last("last_at", ignorenulls=True).over(before),
            "value0": F.last("last_value", ignorenulls=True).over(before),
            "at1": F.last("first_at", ignorenulls=True).over(after),
            "value1": F.last("first_value", ignorenulls=True).over(after),
        }
    ).where("is_mark")

    low_mark = F.greatest(F.col("block"), F.lit(first).cast("bigint"))
    high_mark = F.least(F.col("block") + (block_width - width), F.lit(last).cast("bigint"))
    marks = carried.where(low_mark <= high_mark).select(
        *keys,
        F.explode(F.sequence(low_mark, high_mark, F.lit(width).cast("bigint"))).alias("at"),
        F.lit(None).cast("double").alias("value"),
        F.lit(1).alias("is_mark"),
        "at0", "value0", "at1", "value1",
    )
    ends = F.array(
        F.struct(F.col("first_at").alias("at"), F.col("first_value").alias("value")),
        F.struct(F.col("last_at").alias("at"), F.col("last_value").alias("value")),
    )
    known = edges.select(*keys, F.inline(ends)).withColumn("is_mark", F.lit(0))
    events = known.unionByName(marks, allowMissingColumns=True)

    point_at = F.when(F.col("is_mark") == 0, F.col("at"))
    point_value = F.when(F.col("is_mark") == 0, F.col("value"))
    running = (Window.unboundedPreceding, Window.currentRow)
    # Points sort before marks at the same instant in both directions, so a point on the mark is on both its sides.
    back = Window.partitionBy(*keys).orderBy("at", "is_mark").rowsBetween(*running)
    filled = events.withColumns(
        {
            "p0": F.coalesce(F.last(point_at, ignorenulls=True).over(back), F.col("at0")),
            "v0": F.coalesce(F.last(point_value, ignorenulls=True).over(back), F.col("value0")),
        }
    )
    if name == "stepinterpolation":
        value = F.col("v0")
    else:
        ahead = Window.partitionBy(*keys).orderBy(F.desc("at"), "is_mark").rowsBetween(*running)
        filled = filled.withColumns(
            {
                "p1": F.coalesce(F.last(point_at, ignorenulls=True).over(ahead), F.col("at1")),
                "v1": F.coalesce(F.last(point_value, ignorenulls=True).over(ahead), F.col("value1")),
            }
        )
        share = (F.col("at") - F.col("p0")) / (F.col("p1") - F.col("p0"))
        line = F.col("v0") + (F.col("v1") - F.col("v0")) * share
        value = F.when(F.col("p0") == F.col("at"), F.col("v0")).when(F.col("p1").isNotNull(), line)
    rows = filled.where("is_mark = 1").select(*SERIES, F.col("at").alias("bucket"), value.alias("value"))
    return rows.where(F.col("value").isNotNull())
