"""View definitions: which properties an instance view has and which Spark type each one gets."""

from __future__ import annotations

import keyword
import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import types as T

# The columns every view row carries after its properties.
IDENTITY_COLUMNS = ("space", "external_id")
LIFECYCLE_COLUMNS = ("createdTime", "lastUpdatedTime", "deletedTime")

# Source type name -> Spark type. Any other source type becomes a string.
SPARK_TYPES: Mapping[str, T.DataType] = {
    "int32": T.LongType(),
    "int64": T.LongType(),
    "boolean": T.BooleanType(),
    "float32": T.DoubleType(),
    "float64": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "text": T.StringType(),
}

# Relations, direct or reverse and single or list, are always one string column.
RELATION_TYPES = frozenset({"direct_relation", "reverse_direct_relation"})


def spark_type_for(source_type: str, is_list: bool = False) -> T.DataType:
    name = source_type.lower()
    if name in RELATION_TYPES:
        return T.StringType()
    element = SPARK_TYPES.get(name, T.StringType())
    return T.ArrayType(element, containsNull=True) if is_list else element


def column_name_for(source_key: str) -> str:
    """Names that are Python keywords, or that an identity column already has, get a trailing underscore."""
    taken = source_key in IDENTITY_COLUMNS or source_key in LIFECYCLE_COLUMNS
    return f"{source_key}_" if keyword.iskeyword(source_key) or taken else source_key


def function_name_for(view_external_id: str) -> str:
    """``SmallBoat`` -> ``small_boat_udtf``; names that already end in ``_udtf`` are only lower-cased."""
    if view_external_id.lower().endswith("_udtf"):
        return view_external_id.lower()
    words = re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+[A-Z]?(?![a-z])|\d+", view_external_id)
    return "_".join(w.lower() for w in words) + "_udtf"


@dataclass(frozen=True)
class Property:
    """One view property. ``source_key`` is its name in the records, ``name`` its name as a column."""

    source_key: str
    source_type: str = "text"
    is_list: bool = False
    nullable: bool = True

    @property
    def name(self) -> str:
        return column_name_for(self.source_key)

    @property
    def need_alias(self) -> bool:
        return self.name != self.source_key

    @property
    def spark_type(self) -> T.DataType:
        return spark_type_for(self.source_type, self.is_list)

    @property
    def is_array(self) -> bool:
        return isinstance(self.spark_type, T.ArrayType)

    @property
    def is_numeric(self) -> bool:
        return isinstance(self.spark_type, (T.LongType, T.DoubleType))

    @property
    def field(self) -> T.StructField:
        return T.StructField(self.name, self.spark_type, self.nullable, {"source_key": self.source_key})


@dataclass(frozen=True)
class ViewDef:
    """A versioned view. Its own space names the model, and is not the space its instances live in."""

    space: str
    external_id: str
    version: str
    properties: tuple[Property, ...] = ()
    used_for: str = "node"

    def __post_init__(self) -> None:
        if self.used_for not in {"node", "edge", "all"}:
            raise ValueError(f"used_for must be node, edge or all, not {self.used_for!r}")
        object.__setattr__(self, "properties", tuple(self.properties))
        names = [p.name for p in self.properties]
        repeated = sorted({n for n in names if names.count(n) > 1})
        if repeated:
            raise ValueError(f"repeated property names: {repeated}")

    @property
    def view_key(self) -> str:
        return f"{self.external_id}/{self.version}"

    @property
    def instance_type(self) -> str:
        return "edge" if self.used_for == "edge" else "node"

    @property
    def schema(self) -> T.StructType:
        identity = [T.StructField(c, T.StringType(), False) for c in IDENTITY_COLUMNS]
        lifecycle = [T.StructField(c, T.TimestampType(), True) for c in LIFECYCLE_COLUMNS]
        return T.StructType([p.field for p in self.properties] + identity + lifecycle)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    def find(self, key: str) -> Property | None:
        """The property with this source key or column name, or None."""
        for prop in self.properties:
            if key in (prop.source_key, prop.name):
                return prop
        return None

    def require(self, key: str) -> Property:
        prop = self.find(key)
        if prop is None:
            raise ValueError(f"view {self.view_key} has no property {key!r}")
        return prop
