"""Coercion of untyped record values (VARIANT, so JSON types survive) to the Spark types of a view.

Rules: NULL and JSON null stay NULL; what cannot be read as the wanted type becomes NULL; a relation (an object with
``externalId``, or text such as ``{space=s, externalId=x}``) stands for its external id. All of it is built-in
expressions, evaluated in the JVM.

A rule looks at a value and at what :class:`Read` says of it. :func:`coerce_columns` computes each of those parts once
per value in projections of their own, which also keeps the generated code of a rule small enough for the JVM to
compile.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewloom.functions.timing import ISO_DATE, iso_timestamp

# Texts that mean true, after trimming and lower-casing; every other text means false.
TRUE_TEXTS = ("true", "1", "yes")

NUMBER_TEXT = r"(?i)^[+-]?((\d+[.]?\d*|[.]\d+)(e[+-]?\d+)?|nan|inf|infinity)$"
RELATION_TEXT = r"externalId=([^,}]+)"
MILLIS_PER_DAY = 86_400_000


class Read(NamedTuple):
    """A value with its JSON type name and its text (for objects and lists, their JSON text).

    ``scalar`` is the text to read a scalar from, ``ids`` the external ids if the value is a list of relation objects.
    """

    value: Column
    kind: Column
    text: Column
    scalar: Column | None = None
    ids: Column | None = None

    @property
    def is_text(self) -> Column:
        return self.kind == "STRING"

    @property
    def is_object(self) -> Column:
        return self.kind.startswith("OBJECT")

    @property
    def is_list(self) -> Column:
        return self.kind.startswith("ARRAY")

    @property
    def is_null(self) -> Column:
        return self.kind.isNull() | (self.kind == "VOID")


def _read(value: Column) -> Read:
    return Read(value, F.schema_of_variant(value), F.try_variant_get(value, "$", "string"))


PARTS = ("value", "kind", "text")


def _as_struct(value: Column) -> Column:
    read = _read(value)
    return F.struct(*[getattr(read, part).alias(part) for part in PARTS])


def _from_struct(read: Column) -> Read:
    return Read(*[read[part] for part in PARTS])


def _looks_like_list(text: Column) -> Column:
    return text.rlike(r"^\s*\[[\s\S]*\]\s*$")


def _list_from_text(text: Column) -> Column:
    """The list that a text holds, as a VARIANT; NULL if it holds none."""
    return F.when(_looks_like_list(text), F.try_parse_json(text))


def _id_in_text(text: Column) -> Column:
    return F.when(text.startswith("{"), F.nullif(F.trim(F.regexp_extract(text, RELATION_TEXT, 1)), F.lit("")))


def _id_in_object(value: Column) -> Column:
    return F.coalesce(
        F.try_variant_get(value, "$.externalId", "string"), F.try_variant_get(value, "$.external_id", "string")
    )


def _relation_id(read: Read) -> Column:
    return F.when(read.is_text, _id_in_text(read.text)).when(read.is_object, _id_in_object(read.value))


def relation_id(value: Column) -> Column:
    """External id of a relation value, or NULL if the value is not a relation."""
    return _relation_id(_read(value))


def _with_scalar(read: Read) -> Read:
    """Adds the trimmed text of a JSON text or of a relation's id; NULL for any other JSON type."""
    text = (
        F.when(read.is_text & ~read.text.startswith("{"), read.text)
        .when(read.is_text, F.coalesce(_id_in_text(read.text), read.text))
        .when(read.is_object, _id_in_object(read.value))
    )
    return read._replace(scalar=F.trim(text))


def _text_or_value(read: Read, from_text: Column, from_value: Column) -> Column:
    return F.when(read.is_text | read.is_object, from_text).otherwise(from_value)


def _long(read: Read) -> Column:
    """Numbers are truncated towards zero; text must be an integer."""
    # Text with a fraction is no integer, although Spark's own cast would cut the fraction off.
    from_text = F.when(read.scalar.rlike(r"^[+-]?\d+$"), read.scalar.try_cast("bigint"))
    return _text_or_value(read, from_text, F.try_variant_get(read.value, "$", "bigint"))


def _double(read: Read) -> Column:
    # The pattern keeps out Java's type suffixes ("1.5d"), and the cost of casts that fail.
    from_text = F.when(read.scalar.rlike(NUMBER_TEXT), read.scalar.try_cast("double"))
    return _text_or_value(read, from_text, F.try_variant_get(read.value, "$", "double"))


def _boolean(read: Read) -> Column:
    """Text is true only if it is one of ``TRUE_TEXTS``, else false; numbers are true unless zero."""
    listed = F.when(_looks_like_list(read.scalar), F.to_json(F.try_parse_json(read.scalar)))
    return (
        F.when(read.kind == "BOOLEAN", F.try_variant_get(read.value, "$", "boolean"))
        .when(read.scalar.isNotNull(), F.coalesce(listed != "[]", F.lower(read.scalar).isin(*TRUE_TEXTS)))
        .when(read.is_list | read.is_object, ~read.text.isin("[]", "{}"))
        .otherwise(F.try_variant_get(read.value, "$", "double") != 0)
    )


def _timestamp(read: Read) -> Column:
    """Numbers are epoch milliseconds (0 included); text is ISO 8601, UTC unless it has an offset."""
    millis = F.try_variant_get(read.value, "$", "bigint")
    return _text_or_value(read, iso_timestamp(read.scalar), F.timestamp_millis(millis))


def _date(read: Read) -> Column:
    """Epoch milliseconds in UTC, an ISO date, or an ISO timestamp cut to its date in its own offset."""
    days = F.floor(F.try_variant_get(read.value, "$", "bigint") / MILLIS_PER_DAY).cast("int")
    return _text_or_value(read, _day_in(read.scalar), F.date_add(F.lit("1970-01-01").cast("date"), days))


def _day_in(text: Column) -> Column:
    is_time = (F.substring(text, 11, 1) == "T") & iso_timestamp(text).isNotNull()
    return F.when(text.rlike(ISO_DATE) | is_time, F.substring(text, 1, 10).try_cast("date"))


def _quoted(text: Column) -> Column:
    """A text as a JSON string: a one-element list gets the quoting right, its brackets are cut off again."""
    listed = F.to_json(F.array(text))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def _may_hold_relations(json_text: Column) -> Column:
    return json_text.contains("externalId") | json_text.contains("external_id")


def _with_ids(read: Read) -> Read:
    """Adds the ids of a list of nothing but objects, by one cast of the whole list; NULL for anything else."""
    objects = F.try_variant_get(read.value, "$", "array<struct<externalId: string, external_id: string>>")
    ids = F.transform(objects, lambda o: F.coalesce(o["externalId"], o["external_id"]))
    return read._replace(ids=F.when(read.is_list & _may_hold_relations(read.text), ids))


def _all_relations(ids: Column) -> Column:
    return (F.size(ids) > 0) & ~F.exists(ids, lambda i: i.isNull())


def _json_list_text(listed: Column, json_text: Column) -> Column:
    """JSON text of a list in which each relation is replaced by its external id."""

    def rendered(item: Column) -> Column:
        read = _from_struct(item)
        plain = F.coalesce(F.to_json(read.value), F.lit("null"))
        return F.when(_relation_id(read).isNotNull(), _quoted(_relation_id(read))).otherwise(plain)

    items = F.try_variant_get(listed, "$", "array<variant>")
    parts = F.when(
        _may_hold_relations(json_text), F.transform(F.transform(items, _as_struct), rendered)
    ).otherwise(F.transform(items, lambda item: F.coalesce(F.to_json(item), F.lit("null"))))
    return F.concat(F.lit("["), F.array_join(parts, ", "), F.lit("]"))


def _json_ids_text(ids: Column) -> Column:
    """JSON text of a list of ids; only quotes, backslashes and control characters need JSON's escaping."""
    plain = F.concat(F.lit('["'), F.array_join(ids, '", "'), F.lit('"]'))
    escaped = F.concat(F.lit("["), F.array_join(F.transform(ids, _quoted), ", "), F.lit("]"))
    return F.when(F.array_join(ids, "").rlike(r'["\\\x00-\x1f]'), escaped).otherwise(plain)


def _string(read: Read) -> Column:
    """Text as it is, relations as their external id, lists and objects as JSON text (non-ASCII kept)."""
    starts_list = F.ltrim(read.text).startswith("[")
    listed = _json_list_text(read.value, read.text)
    if read.ids is not None:
        listed = F.when(_all_relations(read.ids), _json_ids_text(read.ids)).otherwise(listed)
    return (
        F.when(read.is_text & ~read.text.startswith("{") & ~starts_list, read.text)
        .when(read.is_text & starts_list, F.coalesce(_json_list_text(_list_from_text(read.text), read.text), read.text))
        .when(read.is_text, F.coalesce(_id_in_text(read.text), read.text))
        .when(read.is_object, F.coalesce(_id_in_object(read.value), read.text))
        .when(read.is_list, listed)
        .otherwise(read.text)
    )


def _list_value(read: Read) -> Column:
    """A list as a VARIANT: a JSON list, or the one that a text holds, unwrapping a list encoded twice."""
    outer = _list_from_text(read.text)
    first = F.try_variant_get(outer, "$[0]", "variant")
    inner = F.when(F.schema_of_variant(first) == "STRING", _list_from_text(F.try_variant_get(outer, "$[0]", "string")))
    return F.when(read.is_list, read.value).when(read.is_text, F.coalesce(inner, outer))


SCALAR_RULES: dict[type[T.DataType], Callable[[Read], Column]] = {
    T.LongType: _long,
    T.DoubleType: _double,
    T.BooleanType: _boolean,
    T.TimestampType: _timestamp,
    T.DateType: _date,
    T.StringType: _string,
}


# Element types for which Spark's own cast of a whole list agrees with the rules wherever it succeeds.
WHOLE_LIST_CASTS = (T.LongType, T.DoubleType, T.StringType)


def _array(read: Read, data_type: T.ArrayType) -> Column:
    rule = SCALAR_RULES[type(data_type.elementType)]

    def element(item: Column) -> Column:
        part = _with_scalar(_from_struct(item))
        return F.when(~part.is_null, rule(part))

    listed = _list_value(read)
    by_element = F.transform(F.transform(F.try_variant_get(listed, "$", "array<variant>"), _as_struct), element)
    if not isinstance(data_type.elementType, WHOLE_LIST_CASTS):
        return by_element
    whole = F.try_variant_get(listed, "$", data_type.simpleString())
    whole = F.coalesce(F.when(~_may_hold_relations(read.text), whole), by_element)
    if isinstance(data_type.elementType, T.StringType):
        return F.when(_all_relations(read.ids), read.ids).otherwise(whole)
    return whole


def _coerce(read: Read, data_type: T.DataType) -> Column:
    rule = SCALAR_RULES.get(type(data_type))
    return F.when(~read.is_null, rule(read) if rule else _array(read, data_type))


def _extra_part(data_type: T.DataType) -> str | None:
    """The part of :class:`Read` that a type needs beyond the first three."""
    element = data_type.elementType if isinstance(data_type, T.ArrayType) else data_type
    if isinstance(element, T.StringType):
        return "ids"
    return None if isinstance(data_type, T.ArrayType) else "scalar"


# Texts that may come from a JSON number whose text is another one, or from an object or list.
UNCLEAR_TEXT = r"^(\s*[\[{]|-0$|-?\d+[.]\d+$|-?\d+([.]\d+)?[eE][+-]?\d+$|-?\d{30,}$)"
# Finds some line for every unclear text, and maybe for others: only \n parts lines here, and a text may hold it.
_END = r"[\r\u0085\u2028\u2029]?$"
UNCLEAR_LINE = (
    r"(?dm)^(?:[ \t\x0B\f\r]*+[\[{]|-0" + _END + r"|-?+\d++(?:[.]\d++(?:[eE][+-]?+\d++)?+|[eE][+-]?+\d++)" + _END + r"|-?\d{30,}+" + _END + ")"
)
INTEGER_TEXT = r"^[+-]?\d+$"
MILLIS_TEXT = r"^-?\d{1,15}$"
YES_NO = ("true", "false", "1", "0")


def is_plain_type(data_type: T.DataType) -> bool:
    """Whether values are read as their text, where that leaves no doubt."""
    return type(data_type) in SCALAR_RULES


def _id_in_json(text: Column) -> Column:
    return F.coalesce(F.get_json_object(text, "$.externalId"), F.get_json_object(text, "$.external_id"))


def unclear_texts(texts: Sequence[Column], data_type: T.DataType, record: Column, relation: bool = False) -> Column:
    """Whether any of the texts could be coerced in two ways, depending on the JSON type that it has in ``record``.

    A text that stands nowhere in the record behind a quote is no JSON text; escapes that could hide one count as doubt.
    """

    def quoted(text: Column) -> Column:
        return record.contains(F.concat(F.lit('"'), text)) | record.contains("\\u00")

    def unclear(text: Column) -> Column:
        if relation:
            return text.rlike(UNCLEAR_TEXT) & (~text.startswith("{") | quoted(F.lit("{")) | _id_in_json(text).isNull())
        if isinstance(data_type, T.StringType):
            return text.rlike(UNCLEAR_TEXT)
        if isinstance(data_type, T.LongType):
            return ~F.trim(text).rlike(INTEGER_TEXT)
        if isinstance(data_type, T.DoubleType):
            return ~F.trim(text).rlike(NUMBER_TEXT)
        if isinstance(data_type, T.BooleanType):
            return ~F.lower(F.trim(text)).isin(*YES_NO)
        return F.when(text.rlike(MILLIS_TEXT), quoted(text)).otherwise(~text.rlike(r"^\d{4}-"))

    found = F.exists(F.array(*texts), lambda text: F.coalesce(unclear(text), F.lit(False)))
    if isinstance(data_type, T.StringType):
        # One search of all texts first: each starts a line, and only if some line is unclear they are looked at singly.
        return F.concat_ws("\n", *texts).rlike(UNCLEAR_LINE) & found
    return found


def from_plain_text(text: Column, data_type: T.DataType, relation: bool = False) -> Column:
    """A scalar from its text, where :func:`unclear_texts` is false."""
    if isinstance(data_type, T.StringType):
        return F.when(text.startswith("{"), _id_in_json(text)).otherwise(text) if relation else text
    if isinstance(data_type, T.BooleanType):
        return F.lower(F.trim(text)).isin(*TRUE_TEXTS)
    if isinstance(data_type, (T.LongType, T.DoubleType)):
        return F.trim(text).try_cast(data_type)
    number, scalar = text.rlike(MILLIS_TEXT), F.trim(text)
    if isinstance(data_type, T.TimestampType):
        return F.when(number, F.timestamp_millis(text.try_cast("bigint"))).otherwise(iso_timestamp(scalar))
    days = F.floor(text.try_cast("bigint") / MILLIS_PER_DAY).cast("int")
    return F.when(number, F.date_add(F.lit("1970-01-01").cast("date"), days)).otherwise(_day_in(scalar))


def _spaced(json_text: Column) -> Column:
    """Compact JSON text with a blank behind each comma and colon that is not inside a string."""
    string = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
    return F.regexp_replace(json_text, rf'\G((?:{string}|[^",:]++)*+)([,:])', "$1$2 ")


def coerce_list(values: Column, data_type: T.DataType) -> Column:
    """Scalars of one type, from a list of (VARIANT value, raw text). Objects and lists in text columns keep the order of
    their keys, which a VARIANT doesn't, if the raw text is theirs."""
    rule = SCALAR_RULES[type(data_type)]

    def parts(entry: Column) -> Column:
        return F.struct(_as_struct(entry["value"]).alias("read"), entry["raw"].alias("raw"))

    def one(entry: Column) -> Column:
        read = _with_scalar(_from_struct(entry["read"]))
        result = rule(read)
        if isinstance(data_type, T.StringType):
            held = (read.is_object & _id_in_object(read.value).isNull()) | (read.is_list & ~_may_hold_relations(read.text))
            same = F.to_json(F.try_parse_json(entry["raw"])) == F.to_json(read.value)
            result = F.when(held & same, _spaced(entry["raw"])).otherwise(result)
        return F.when(~read.is_null, result)

    return F.transform(F.transform(values, parts), one)


def coerce(value: Column, data_type: T.DataType) -> Column:
    """A VARIANT value as ``data_type``, which is one of the types a view property can have."""
    return _coerce(_with_ids(_with_scalar(_read(value))), data_type)


def coerce_columns(
    rows: DataFrame, wanted: Mapping[str, tuple[Column, T.DataType]], keep: tuple[str, ...] = (), plain: Mapping[str, Column] | None = None
) -> DataFrame:
    """``keep``, the wanted values, coerced, and ``plain`` columns of another making. Values, then their types and texts, are
    computed once each."""
    labels = {name: f"_{i}" for i, name in enumerate(wanted)}
    asked, plain = keep, plain or {}
    held = {name: f"_plain_{i}" for i, name in enumerate(plain)}
    kept = [F.col(c) for c in keep] + [column.alias(held[name]) for name, column in plain.items()]
    keep = (*keep, *held.values())
    values = rows.select(*kept, *[value.alias(labels[name]) for name, (value, _) in wanted.items()])
    reads = values.select(
        *keep,
        *[
            getattr(_read(F.col(label)), part).alias(f"{label}_{part}")
            for label in labels.values()
            for part in PARTS
        ],
    )

    def parts(name: str) -> Read:
        return Read(*[F.col(f"{labels[name]}_{part}") for part in PARTS])

    extras = {name: _extra_part(data_type) for name, (_, data_type) in wanted.items()}
    complete = reads.select(
        "*",
        *[
            getattr(_with_ids(_with_scalar(parts(name))), extra).alias(f"{labels[name]}_{extra}")
            for name, extra in extras.items()
            if extra
        ],
    )
    columns = []
    for name, (_, data_type) in wanted.items():
        read, extra = parts(name), extras[name]
        if extra:
            read = read._replace(**{extra: F.col(f"{labels[name]}_{extra}")})
        columns.append(_coerce(read, data_type).alias(name))
    # A generator of one row: conditions above it are evaluated on its results. Spark would push them below a plain projection and
    # put the whole of a rule in place of each mention of its column.
    columns += [F.col(label).alias(name) for name, label in held.items()]
    return complete.select(*asked, F.inline(F.array(F.struct(*columns))))
