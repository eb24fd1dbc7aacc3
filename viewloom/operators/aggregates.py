"""Instance aggregates over a view: count, min and max, whole or by group.

Every metric is a partial aggregate, so a hot group costs one row per task in the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewloom.model import IDENTITY_COLUMNS, LIFECYCLE_COLUMNS, ViewDef
from viewloom.operators.filters import Arguments, FilterSpec, condition

# Fixed value: the metrics of one aggregate call, at most.
MAX_METRICS = 5

FUNCTIONS = {"count": F.count, "min": F.min, "max": F.max}
IDENTITY_KEYS = {"externalId": "external_id", "external_id": "external_id", "space": "space"}


@dataclass(frozen=True)
class Metric:
    """``count``, ``min`` or ``max`` of a property; ``count`` of ``externalId`` counts instances."""

    fn: str
    property: str
    alias: str | None = None

    @classmethod
    def of(cls, entry: object) -> Metric | None:
        """A metric or a map with its fields, tidied up; None if it lacks a function or a property."""
        fields = vars(entry) if isinstance(entry, Metric) else entry if isinstance(entry, Mapping) else {}
        fn, prop = (str(fields.get(name) or "").strip() for name in ("fn", "property"))
        return cls(fn.lower(), prop, fields.get("alias")) if fn and prop else None

    @property
    def counts_instances(self) -> bool:
        return self.fn == "count" and IDENTITY_KEYS.get(self.property) == "external_id"

    @property
    def name(self) -> str:
        return self.alias or f"{self.fn}_{'externalId' if self.counts_instances else self.property}"


def parse_metrics(metrics: str | Iterable[Metric | Mapping[str, object]]) -> list[Metric]:
    """Metrics from a list or its JSON text. Entries without fn or property are skipped; none left is an error."""
    listed = Arguments.from_text(metrics, list) if isinstance(metrics, str) else list(metrics)
    if not listed:
        raise ValueError("an aggregate needs a list of metrics")
    if len(listed) > MAX_METRICS:
        raise ValueError(f"at most {MAX_METRICS} metrics in one aggregate, not {len(listed)}")
    usable = [metric for metric in map(Metric.of, listed) if metric is not None]
    if not usable:
        raise ValueError("none of the metrics is valid")
    return usable


def _check(view: ViewDef, metric: Metric) -> None:
    if metric.fn not in FUNCTIONS:
        raise ValueError(f"unknown aggregate {metric.fn!r}")
    if metric.counts_instances:
        return
    prop = view.require(metric.property)
    if metric.fn in ("min", "max") and not prop.is_numeric:
        raise ValueError(
            f"{metric.fn} needs a numeric property; {metric.property!r} is {prop.spark_type.simpleString()}"
        )


def _metric_column(view: ViewDef, metric: Metric) -> Column:
    if metric.counts_instances:
        return F.count(F.lit(1))
    return FUNCTIONS[metric.fn](F.col(view.require(metric.property).name))


def _group_keys(group_by: str | Sequence[str]) -> Sequence[str]:
    keys = Arguments.from_text(group_by, list) if isinstance(group_by, str) else group_by
    if keys is None:
        raise ValueError(f"group keys are a list of property names, not {group_by!r}")
    return keys


def _group_column(view: ViewDef, key: str) -> str:
    return IDENTITY_KEYS[key] if key in IDENTITY_KEYS and view.find(key) is None else view.require(key).name


def aggregate(
    table: DataFrame,
    view: ViewDef,
    metrics: str | Iterable[Metric | Mapping[str, object]],
    group_by: str | Sequence[str] = (),
    spec: FilterSpec | None = None,
    max_groups: int | None = None,
) -> DataFrame:
    """One row per group (one row in all without groups): the group keys, then one column per metric.

    ``max_groups`` keeps the first groups in key order; by default all groups are kept.
    """
    parsed = parse_metrics(metrics)
    for metric in parsed:
        _check(view, metric)
    keys = [_group_column(view, key) for key in _group_keys(group_by)]
    rows = table.where(condition(view, spec, table.schema)) if spec is not None else table
    columns = [_metric_column(view, m).alias(m.name) for m in parsed]
    result = rows.groupBy(*keys).agg(*columns)
    return result if max_groups is None else result.orderBy(*keys).limit(max_groups)


def long_form(aggregated: DataFrame, metrics: str | Iterable[Metric | Mapping[str, object]]) -> DataFrame:
    """The result of :func:`aggregate` with one row per metric: group keys, aggregate, property, value."""
    parsed = parse_metrics(metrics)
    names = {m.name for m in parsed}
    keys = [c for c in aggregated.columns if c not in names]
    entries = F.array(
        *[
            F.struct(
                F.lit(m.fn).alias("aggregate"),
                F.lit("externalId" if m.counts_instances else m.property).alias("property"),
                (F.coalesce(F.col(m.name), F.lit(0)) if m.fn == "count" else F.col(m.name))
                .cast("double")
                .alias("value"),
            )
            for m in parsed
        ]
    )
    return aggregated.select(*keys, F.inline(entries))


def as_view_rows(
    aggregated: DataFrame,
    view: ViewDef,
    metrics: str | Iterable[Metric | Mapping[str, object]],
    group_by: str | Sequence[str] = (),
) -> DataFrame:
    """The result of :func:`aggregate` in the view's own layout.

    A metric sits in its property's column and the instance count, as text, in ``external_id``. Where several values
    want one column the last wins, group keys before metrics; ``space`` and ``external_id`` may be NULL here.
    """
    placed: dict[str, Column] = {}
    for key in _group_keys(group_by):
        name = _group_column(view, key)
        placed[name] = F.col(name)
    for metric in parse_metrics(metrics):
        target = "external_id" if metric.counts_instances else view.require(metric.property).name
        placed[target] = F.col(metric.name)
    types = {f.name: f.dataType for f in view.schema.fields}
    order = [p.name for p in view.properties] + list(IDENTITY_COLUMNS) + list(LIFECYCLE_COLUMNS)
    return aggregated.select(
        *[placed.get(c, F.lit(None)).try_cast(types[c]).alias(c) for c in order]
    )


def grouped_counts(
    table: DataFrame, view: ViewDef, group_by: Sequence[str], spec: FilterSpec | None = None
) -> DataFrame:
    """Instances per group, as the group keys and ``count``."""
    return aggregate(table, view, [Metric("count", "externalId", "count")], group_by, spec)
