"""View scans: the rows of a view table that pass a filter, optionally only some columns and at most some rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewloom.model import LIFECYCLE_COLUMNS, ViewDef
from viewloom.operators.filters import FilterSpec, condition


def conform(table: DataFrame, view: ViewDef) -> DataFrame:
    """A typed table as the view's columns in order. Source keys are renamed; missing lifecycle columns are NULL.

    If the table tells nodes from edges (``instance_type``), only the view's kind is kept. Columns of another type than
    declared are cast, but TIMESTAMP_NTZ stays, as a cast would keep filters from the scan; it means UTC throughout.
    """
    present = set(table.columns)
    rows = table
    if "instance_type" in present:
        rows = rows.where(F.col("instance_type") == view.instance_type)
    columns = []
    for prop in view.properties:
        held = prop.name if prop.name in present else prop.source_key
        kind, column = table.schema[held].dataType, F.col(f"`{held}`")
        same = kind == prop.spark_type or (isinstance(kind, T.TimestampNTZType) and isinstance(prop.spark_type, T.TimestampType))
        columns.append((column if same else column.cast(prop.spark_type)).alias(prop.name))
    columns += [F.col("space"), F.col("external_id")]
    columns += [F.col(c) if c in present else F.lit(None).cast("timestamp").alias(c) for c in LIFECYCLE_COLUMNS]
    return rows.select(*columns)


def row_limit(value: object) -> int | None:
    """A usable row limit, or None for no limit: NULL, text that is no integer, and negative numbers mean none."""
    try:
        limit = int(value) if value is not None else None
    except (TypeError, ValueError):
        return None
    return limit if limit is not None and limit >= 0 else None


def scan(
    table: DataFrame,
    view: ViewDef,
    spec: FilterSpec | None = None,
    columns: Sequence[str] | None = None,
    limit: object = None,
) -> DataFrame:
    """Rows of ``table`` (view layout, see :func:`conform`) that pass ``spec``.

    ``limit`` takes any rows; to get the first ones of an order, use ``orderBy(...).limit(n)`` on the result instead.
    """
    rows = table.where(condition(view, spec, table.schema)) if spec is not None else table
    if columns is not None:
        rows = rows.select(*columns)
    count = row_limit(limit)
    return rows if count is None else rows.limit(count)
