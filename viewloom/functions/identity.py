"""Instance ids: the text ``space:external_id``, split at the first colon only."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class InstanceId(NamedTuple):
    space: str
    external_id: str

    def __str__(self) -> str:
        return f"{self.space}:{self.external_id}"


def parse_instance_id(text: str) -> InstanceId:
    space, colon, external_id = (text or "").partition(":")
    parsed = InstanceId(space.strip(), external_id.strip())
    if not colon or not parsed.space or not parsed.external_id:
        raise ValueError(f"an instance id looks like 'space:external_id', not {text!r}")
    return parsed


def parse_instance_ids(ids: str | Iterable[str | tuple[str, str]]) -> list[InstanceId]:
    """Ids from one comma-separated text, or from a list of texts or pairs (which may hold commas)."""
    if isinstance(ids, str):
        parts: list = [part for part in ids.split(",") if part.strip()]
    else:
        parts = list(ids)
    if not parts:
        raise ValueError("at least one instance id is required")
    parsed = [parse_instance_id(p) if isinstance(p, str) else parse_instance_id(f"{p[0]}:{p[1]}") for p in parts]
    return list(dict.fromkeys(parsed))


def instance_id_struct(text: Column) -> Column:
    """Column form: struct(space, external_id), or NULL where the text is not an instance id."""
    parts = F.split(text, ":", 2)
    space, external_id = F.trim(F.get(parts, 0)), F.trim(F.get(parts, 1))
    return F.when(
        (space != "") & (external_id != ""),
        F.struct(space.alias("space"), external_id.alias("external_id")),
    )


def instance_id_array(text: Column) -> Column:
    """Column form of a comma list: blanks are skipped, and any other bad item fails the query."""
    items = F.filter(F.transform(F.split(text, ","), lambda item: F.trim(item)), lambda item: item != "")

    def checked(item: Column) -> Column:
        bad = F.raise_error(F.concat(F.lit("an instance id looks like 'space:external_id', not "), item))
        parsed = instance_id_struct(item)
        return F.when(parsed.isNull(), bad.cast("struct<space:string,external_id:string>")).otherwise(parsed)

    return F.transform(items, checked)


def composite_id(space: Column, external_id: Column) -> Column:
    return F.concat(space, F.lit(":"), external_id)
