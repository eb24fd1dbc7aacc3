"""Time arguments, as Python values and as Column expressions.

Accepted: ``now``, ``<n><s|m|h|d|w>-ago`` and ``-ahead``, ISO 8601 or SQL timestamp text (no offset means UTC),
datetimes, dates and epoch milliseconds. Results have millisecond precision.
"""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Seconds in each unit of relative times and granularities.
UNIT_SECONDS = {"s": 1, "m": 60, "h": 3600, "d": 86400, "w": 604800}

RELATIVE = r"^(\d+)([smhdw])-(ago|ahead)$"
ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.]\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$"
# The commonest form, which Spark's cast reads as it is, and a bare date.
ISO_FULL = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}([.]\d+)?(Z|[+-]\d{2}:\d{2})$"
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
GRANULARITY = r"^(\d+)([smhdw])$"

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)

TimeArgument = str | int | float | datetime | date


def as_utc(value: datetime | date) -> datetime:
    if not isinstance(value, datetime):
        value = datetime(value.year, value.month, value.day)
    return value.replace(tzinfo=timezone.utc) if value.tzinfo is None else value.astimezone(timezone.utc)


def _parse_iso(text: str) -> datetime | None:
    if not re.match(ISO, text):
        return None
    text = re.sub(r"Z$", "+00:00", text)
    text = re.sub(r"([+-]\d{2})(\d{2})$", r"\1:\2", text) if "T" in text or " " in text else text
    text = re.sub(r"\.(\d+)", lambda m: "." + m.group(1)[:6].ljust(6, "0"), text)
    try:
        return as_utc(datetime.fromisoformat(text))
    except ValueError:
        return None


def resolve_time(value: TimeArgument, now: datetime | None = None) -> datetime:
    """A time argument as an aware UTC datetime. Every argument of one call should share one ``now``."""
    now = as_utc(now) if now is not None else datetime.now(timezone.utc)
    if isinstance(value, (datetime, date)):
        moment = as_utc(value)
    elif isinstance(value, (int, float)) and not isinstance(value, bool):
        return EPOCH + timedelta(milliseconds=int(value))
    elif isinstance(value, str):
        text = value.strip()
        relative = re.match(RELATIVE, text.lower())
        if text.lower() == "now":
            moment = now
        elif relative:
            span = timedelta(seconds=int(relative.group(1)) * UNIT_SECONDS[relative.group(2)])
            moment = now - span if relative.group(3) == "ago" else now + span
        elif re.match(r"^-?\d+$", text):
            return EPOCH + timedelta(milliseconds=int(text))
        else:
            parsed = _parse_iso(text)
            if parsed is None:
                raise ValueError(f"not a time: {value!r}")
            moment = parsed
    else:
        raise TypeError(f"not a time: {value!r}")
    return moment - timedelta(microseconds=moment.microsecond % 1000)


def granularity_seconds(granularity: str) -> int:
    match = re.match(GRANULARITY, (granularity or "").strip().lower())
    if not match or int(match.group(1)) < 1:
        raise ValueError(f"a granularity looks like 30s, 15m, 1h, 1d or 2w, not {granularity!r}")
    return int(match.group(1)) * UNIT_SECONDS[match.group(2)]


def time_literal(moment: datetime, data_type: T.DataType) -> Column:
    """A foldable literal of the column's own timestamp type, so that comparisons reach the file scan."""
    utc = as_utc(moment)
    if isinstance(data_type, T.TimestampNTZType):
        return F.lit(utc.strftime("%Y-%m-%d %H:%M:%S.%f")).cast(T.TimestampNTZType())
    return F.lit(utc)


def iso_timestamp(text: Column) -> Column:
    """ISO 8601 text to TIMESTAMP; without an offset it is UTC; anything else is NULL."""
    # Spark's cast wants seconds, a colon in the offset and, to mean UTC in any session, an offset.
    full = F.regexp_replace(text, r"([T ]\d{2}:\d{2})(Z|[+-]\d{2}:?\d{2})?$", "$1:00$2")
    full = F.regexp_replace(full, r"(:\d{2}[.]?\d*[+-]\d{2})(\d{2})$", "$1:$2")
    full = F.regexp_replace(full, r"^(.{10}[T ]\d{2}:\d{2}:\d{2}([.]\d+)?)$", "$1Z")
    full = F.regexp_replace(full, r"^(.{10})$", "$1T00:00:00Z")
    return F.when(text.rlike(ISO_FULL), text.try_cast("timestamp")).when(text.rlike(ISO), full.try_cast("timestamp"))


def resolve_time_column(text: Column, now: Column) -> Column:
    """Column form of :func:`resolve_time` for text; a text that is no time gives NULL."""
    value = F.lower(F.trim(text))
    amount = F.regexp_extract(value, RELATIVE, 1).try_cast("bigint")
    unit = F.regexp_extract(value, RELATIVE, 2)
    seconds = F.lit(None).cast("bigint")
    for name, size in UNIT_SECONDS.items():
        seconds = F.when(unit == name, F.lit(size).cast("bigint")).otherwise(seconds)
    sign = F.when(F.regexp_extract(value, RELATIVE, 3) == "ago", F.lit(-1)).otherwise(F.lit(1))
    shifted = F.timestamp_micros(F.unix_micros(now) + sign * amount * seconds * 1_000_000)
    resolved = (
        F.when(value == "now", now)
        .when(value.rlike(RELATIVE), shifted)
        .when(value.rlike(r"^-?\d+$"), F.timestamp_millis(value.try_cast("bigint")))
        .otherwise(iso_timestamp(F.upper(value)))
    )
    return F.date_trunc("millisecond", resolved)
