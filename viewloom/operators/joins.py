"""Joins between views, and between a view and the series that its rows refer to.

All are equi-joins, left to Spark to broadcast or shuffle by measured size; adaptive execution splits a hot key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewloom.functions.identity import instance_id_struct


def join_on_reference(left: DataFrame, right: DataFrame, reference: str, key: str = "external_id") -> DataFrame:
    """Rows of ``left`` with the rows of ``right`` whose ``reference`` column holds the left ``key``."""
    return left.alias("l").join(right.alias("r"), F.col(f"l.{key}") == F.col(f"r.{reference}"), "inner")


def join_on_instance(left: DataFrame, right: DataFrame, reference: str) -> DataFrame:
    """As :func:`join_on_reference`, but both sides must also lie in the same space."""
    same = (F.col("l.space") == F.col("r.space")) & (F.col("l.external_id") == F.col(f"r.{reference}"))
    return left.alias("l").join(right.alias("r"), same, "inner")


def join_on_property(left: DataFrame, right: DataFrame, left_property: str, right_property: str) -> DataFrame:
    """Rows that agree on a property, compared in the left column's type."""
    left_type = left.schema[left_property].dataType
    return left.alias("l").join(
        right.alias("r"),
        F.col(f"l.{left_property}") == F.col(f"r.{right_property}").cast(left_type),
        "inner",
    )


def _reference(space: str | None, external_id: str | None, instance_id: str | None) -> tuple[Column, Column]:
    """Space and external id of the series that a row refers to, by two columns or one id text."""
    if instance_id is not None:
        named = instance_id_struct(F.col(instance_id))
        return named["space"], named["external_id"]
    return F.col(space), F.col(external_id)


def referred_series(rows: DataFrame, references: Sequence[Mapping[str, str]]) -> DataFrame:
    """The distinct (space, external_id) that rows refer to, by references as :func:`with_series` takes them.

    A left semi join of the points with these, before a rollup, leaves the series out that nothing will join; one rollup
    then serves all the references.
    """
    found = []
    for reference in references:
        space, external_id = _reference(*(reference.get(k) for k in ("space", "external_id", "instance_id")))
        found.append(rows.select(space.alias("space"), external_id.alias("external_id")))
    return reduce(DataFrame.unionByName, found).where("space IS NOT NULL AND external_id IS NOT NULL").distinct()


def with_series(
    rows: DataFrame,
    series: DataFrame,
    values: Mapping[str, str],
    space: str | None = None,
    external_id: str | None = None,
    instance_id: str | None = None,
    aligned: tuple[str, str] | None = None,
) -> DataFrame:
    """Each row with every point of the series it refers to, by (space, external id) columns or one id text.

    ``values`` says which columns of ``series`` to add and under which names. Rows without a reference are dropped
    before the join, and an id text is split once per row, so the join stays on the two key columns. Calling this
    twice puts two series next to one row; ``aligned=(row column, series column)`` then pairs equal times only,
    instead of every point of one with every point of the other.
    """
    ref_space, ref_id = _reference(space, external_id, instance_id)
    left = rows.withColumns({"_space": ref_space, "_external_id": ref_id}).where(
        F.col("_space").isNotNull() & F.col("_external_id").isNotNull()
    )
    right = series.select(
        F.col("space").alias("_s_space"),
        F.col("external_id").alias("_s_external_id"),
        *[F.col(source).alias(target) for source, target in values.items()],
        *([F.col(aligned[1]).alias("_s_time")] if aligned else []),
    )
    match = (F.col("_space") == F.col("_s_space")) & (F.col("_external_id") == F.col("_s_external_id"))
    if aligned:
        match = match & (F.col(aligned[0]) == F.col("_s_time"))
    return left.join(right, match, "inner").select(*rows.columns, *values.values())
