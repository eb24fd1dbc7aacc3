"""Filters over a view: a set of conditions, all of which must hold, as one Column that Catalyst can push down."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date, datetime, timezone
from functools import reduce
from operator import and_, ge, gt, le, lt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewloom.functions.timing import as_utc, resolve_time, time_literal
from viewloom.model import Property, ViewDef

COMPARISONS = {"gt": gt, "gte": ge, "lt": lt, "lte": le}


class Arguments:
    """Reads a caller's filter arguments against a view: Python values or JSON text, always with names the view has."""

    def __init__(self, view: ViewDef, now: datetime | None = None) -> None:
        self.view = view
        self.now = as_utc(now) if now is not None else datetime.now(timezone.utc)  # one for all relative times of a call

    @staticmethod
    def from_text(text: str, kind: type) -> object | None:
        """The JSON value of a text if it is of the given kind; None for any other text."""
        try:
            value = json.loads(text)
        except ValueError:
            return None
        return value if isinstance(value, kind) else None

    def alternatives(self, value: object) -> list[object] | None:
        """The values of a list, without NULLs; None for a single value, which text is unless it is a JSON list."""
        if isinstance(value, str):
            value = self.from_text(value, list)
        return [v for v in value if v is not None] if isinstance(value, (list, tuple, set, frozenset)) else None

    def properties(self, value: object) -> list[Property]:
        """The properties that one name or a list of names stands for."""
        if value is None or value == "":
            return []
        names = self.alternatives(value)
        return [self.view.require(str(name)) for name in ([value] if names is None else names)]

    def bounds(self, value: object) -> list[tuple[Property, object]]:
        """Properties with their bounds from a map of names to values; NULL bounds are left out."""
        if value is None or value == "":
            return []
        given = self.from_text(value, dict) if isinstance(value, str) else value
        if not isinstance(given, Mapping):
            raise ValueError(f"bounds are a map of property names to values, not {value!r}")
        return [(self.view.require(str(name)), bound) for name, bound in given.items() if bound is not None]


@dataclass(frozen=True)
class FilterSpec:
    """What to keep. A list value means "any of"; None means no condition. JSON text is accepted for lists and maps."""

    equals: Mapping[str, object] = field(default_factory=dict)
    exists: object = None
    not_exists: object = None
    instance_space: object = None
    external_id: object = None
    gt: object = None
    gte: object = None
    lt: object = None
    lte: object = None


def literal(value: object, data_type: T.DataType, now: datetime | None = None) -> Column:
    """A literal of the column's own type, so that no cast lands on the column and blocks pushdown."""
    if value is None:
        return F.lit(None).cast(data_type)
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        if isinstance(value, datetime):
            moment = value if value.tzinfo else value.replace(tzinfo=timezone.utc)
        else:
            moment = resolve_time(value, now)
        return time_literal(moment, data_type)
    if isinstance(data_type, T.DateType):
        if isinstance(value, datetime):
            value = value.date()
        return F.lit(value if isinstance(value, date) else str(value)).cast(data_type)
    if isinstance(data_type, (T.LongType, T.IntegerType)):
        try:
            number = value if isinstance(value, float) else int(value)
        except ValueError:
            number = float(value)
        # A fraction must not be cut off by a cast: 5.7 equals no integer and lies between 5 and 6.
        return F.lit(int(number)).cast(data_type) if number == int(number) else F.lit(number)
    if isinstance(data_type, T.DoubleType):
        return F.lit(float(value))
    if isinstance(data_type, T.BooleanType):
        return F.lit(value if isinstance(value, bool) else str(value).strip().lower() in ("true", "1", "yes"))
    if isinstance(value, (dict, list)):
        value = json.dumps(value, ensure_ascii=False)
    return F.lit(value if isinstance(value, str) else str(value))


def _equal_or_in(column: Column, value: object, data_type: T.DataType, arguments: Arguments) -> Column:
    options = arguments.alternatives(value)
    if options is None:
        return column == literal(value, data_type, arguments.now)
    if not options:
        return F.lit(False)
    wanted = [literal(v, data_type, arguments.now) for v in options]
    return column == wanted[0] if len(wanted) == 1 else column.isin(*wanted)


def _contains_any(column: Column, value: object, data_type: T.ArrayType, arguments: Arguments) -> Column:
    options = arguments.alternatives(value)
    wanted = F.array(*[literal(v, data_type.elementType, arguments.now) for v in ([value] if options is None else options)])
    return F.coalesce(F.arrays_overlap(column, wanted.cast(data_type)), F.lit(False))


def condition(view: ViewDef, spec: FilterSpec, schema: T.StructType, now: datetime | None = None) -> Column:
    """The conjunction of the spec's conditions; true if there are none. ``schema`` is that of the filtered table.

    Names that the view lacks and bounds that are no map are errors. Relative times are all relative to one ``now``.
    """
    arguments = Arguments(view, now)
    conjuncts: list[Column] = []
    for key, value in spec.equals.items():
        name = view.require(key).name
        if value is not None:
            data_type = schema[name].dataType
            build = _contains_any if isinstance(data_type, T.ArrayType) else _equal_or_in
            conjuncts.append(build(F.col(name), value, data_type, arguments))
    conjuncts += [F.col(prop.name).isNotNull() for prop in arguments.properties(spec.exists)]
    conjuncts += [F.col(prop.name).isNull() for prop in arguments.properties(spec.not_exists)]
    for name, value in (("space", spec.instance_space), ("external_id", spec.external_id)):
        if value is not None:
            conjuncts.append(_equal_or_in(F.col(name), value, schema[name].dataType, arguments))
    for operation, compare in COMPARISONS.items():
        for prop, bound in arguments.bounds(getattr(spec, operation)):
            conjuncts.append(compare(F.col(prop.name), literal(bound, schema[prop.name].dataType, arguments.now)))
    return reduce(and_, conjuncts) if conjuncts else F.lit(True)
