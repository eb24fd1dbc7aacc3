"""Instance records: pages of JSON to one row per instance, and the properties of one view resolved from each.

A page is ``{"items": [...]}``. An item carries its view properties nested as
``properties[view space][view/version]``, in ``sources`` (a list, or a map keyed by ``view/version``), or at its top
level. Only the parts that the view needs are parsed.

An item is read with a schema made from the view: scalars and single relations as their text, lists as VARIANT. The few rows that this schema doesn't fit, or whose texts could stand for two things (is
``1.5`` a number or a text?), are read again wholly as VARIANT, in the same pass and without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewloom.functions.coercion import coerce_columns, coerce_list, from_plain_text, is_plain_type, unclear_texts
from viewloom.model import LIFECYCLE_COLUMNS, RELATION_TYPES, Property, ViewDef

ENVELOPE = ("space", "externalId", "external_id", "instanceType", "properties", "sources")
SOURCES_MAP = r'"sources"\s*:\s*\{'
#: Holds an item's whole text if the item doesn't fit its read schema.
MISFIT = "__misfit"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row per page file (column ``page``); a page is bounded by the writer, a directory is not."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "page")


def read_as_text(prop: Property) -> bool:
    """Whether a property is read as its text; lists, also of relations, are read as VARIANT."""
    return is_plain_type(prop.spark_type) and not (is_relation(prop) and (prop.is_list or prop.source_type.lower() != "direct_relation"))


def is_relation(prop: Property) -> bool:
    return prop.source_type.lower() in RELATION_TYPES


def _top_level(view: ViewDef) -> list[Property]:
    return [p for p in view.properties if p.source_key not in ENVELOPE and p.source_key not in LIFECYCLE_COLUMNS]


def _leaf(prop: Property) -> T.StructField:
    return T.StructField(prop.source_key, T.StringType() if read_as_text(prop) else T.VariantType())


def _envelope(view: ViewDef, properties: T.DataType, sources: T.DataType, lifecycle: T.DataType, top: list[T.StructField]) -> T.StructType:
    texts = [T.StructField(c, T.StringType()) for c in ("space", "externalId", "external_id", "instanceType")]
    # Maps keep the record's own order of spaces, which decides the fallback.
    nested = [T.StructField("properties", T.MapType(T.StringType(), properties)), T.StructField("sources", sources)]
    return T.StructType([*texts, *nested, *[T.StructField(c, lifecycle) for c in LIFECYCLE_COLUMNS], *top])


def item_schema(view: ViewDef, listed: bool) -> T.StructType:
    """The read schema of one item, with ``sources`` as a list or else as a map. Other views' objects are passed over."""
    leaves = T.StructType([_leaf(p) for p in view.properties] or [T.StructField(MISFIT, T.StringType())])
    source = T.StructType([T.StructField(c, T.StringType()) for c in ("space", "externalId", "external_id", "version")])
    entry = T.StructType([T.StructField("source", source), T.StructField("properties", leaves)])
    of_view = T.StructType([T.StructField(view.view_key, leaves)])
    schema = _envelope(view, of_view, T.ArrayType(entry) if listed else of_view, T.LongType(), [_leaf(p) for p in _top_level(view)])
    return schema.add(MISFIT, T.StringType())


def variant_schema(view: ViewDef) -> T.StructType:
    """The read schema of an item that fits neither form of :func:`item_schema`."""
    top = [T.StructField(p.source_key, T.VariantType()) for p in _top_level(view)]
    return _envelope(view, T.VariantType(), T.VariantType(), T.VariantType(), top)


def unnest_pages(pages: DataFrame, view: ViewDef, page: str = "page") -> DataFrame:
    """Rows of ``item``, one per element of ``items``; a page without ``items`` gives no row."""
    texts = F.from_json(F.col(page), "items array<string>")["items"]
    return parse_items(pages.select(F.explode(texts).alias("record")), view)


def parse_items(records: DataFrame, view: ViewDef, record: str = "record") -> DataFrame:
    """Rows of ``item`` from a table with one JSON record text per row: only nodes or only edges, as the view wants."""
    options = {"columnNameOfCorruptRecord": MISFIT}
    # A guess at the form of ``sources``; a wrong one only costs time, as what doesn't fit is read again.
    text = F.col("record")
    is_map = text.contains('"sources"') & text.rlike(SOURCES_MAP)
    named = records.select(F.col(record).alias("record")).select("record", (~is_map).alias("guess"))
    as_list = F.from_json(F.when(F.col("guess"), text), item_schema(view, True), options)
    first = named.select("record", "guess", as_list.alias("a"))
    a, b = F.col("a"), F.col("b")
    in_first = F.coalesce(F.col("guess"), F.lit(False)) & a[MISFIT].isNull()
    of_map = F.when(in_first, None).otherwise(text)
    second = first.select("record", in_first.alias("in_first"), "a", F.from_json(of_map, item_schema(view, False), options).alias("b"))
    kind = F.coalesce(a["instanceType"], b["instanceType"], F.lit("node"))
    keep = (a.isNotNull() | b.isNotNull()) & (kind == view.instance_type)
    # Both readings are kept whole: a struct is copied at once, while hundreds of fields picked from it are copied one by one.
    rows = second.select(keep.alias("keep"), F.struct("record", "in_first", "a", "b").alias("item"))
    # A generator: no filter above it makes Spark parse the JSON again.
    return rows.select(F.explode(F.when(F.col("keep"), F.array("item"))).alias("item"))


def _all(conditions: list[Column]) -> Column:
    """Whether all hold, as a tree of low depth."""
    if len(conditions) == 1:
        return conditions[0]
    half = len(conditions) // 2
    return _all(conditions[:half]) & _all(conditions[half:])


def _picked(item: Column, name: str) -> Column:
    """A field of the reading that an item fits."""
    return F.when(item["in_first"], item["a"][name]).otherwise(item["b"][name])


def _json_path(*keys: str) -> str:
    return "$" + "".join("['" + k.replace("\\", "\\\\").replace("'", "\\'") + "']" for k in keys)


def _present(value: Column) -> Column:
    """JSON null counts as absent."""
    return F.when(~F.is_variant_null(value), value)


def nested_object(properties: Column, view: ViewDef) -> Column:
    """The view's object under its own space or, if that gives nothing, under the first space that has the view."""
    path = _json_path(view.view_key)
    own = F.try_variant_get(F.try_element_at(properties, F.lit(view.space)), path, "variant")
    holders = F.filter(
        F.map_values(properties),
        lambda views: F.schema_of_variant(F.try_variant_get(views, path, "variant")).startswith("OBJECT"),
    )
    other = F.try_variant_get(F.get(holders, 0), path, "variant")
    whole = F.schema_of_variant(own)
    return F.when(whole.startswith("OBJECT") & (whole != "OBJECT<>"), own).otherwise(other)


def listed_objects(sources: Column, view: ViewDef) -> Column:
    """The property objects of all entries of a ``sources`` list that name this view."""

    def names_view(entry: Column) -> Column:
        part = lambda name: F.try_variant_get(entry, f"$.source.{name}", "string")
        return _names(view, part("space"), part("externalId"), part("external_id"), part("version"))

    matching = F.filter(F.try_variant_get(sources, "$", "array<variant>"), names_view)
    return F.transform(matching, lambda entry: F.try_variant_get(entry, "$.properties", "variant"))


def _names(view: ViewDef, space: Column, external_id: Column, other_id: Column, version: Column) -> Column:
    key = F.concat(F.coalesce(F.nullif(external_id, F.lit("")), other_id), F.lit("/"), version)
    return (space == view.space) & (key == view.view_key)


def _last_given(objects: Column, path: str) -> Column:
    values = F.transform(objects, lambda o: _present(F.try_variant_get(o, path, "variant")))
    return F.try_element_at(F.filter(values, lambda v: v.isNotNull()), F.lit(-1))


def _typed_values(items: DataFrame, view: ViewDef) -> DataFrame:
    """Of each item its ``record`` and ``envelope``, the view's values as read in the struct ``read`` (by source key; JSON null in
    a VARIANT may be left), and ``unclear`` where they must be read as VARIANT.

    The values stay in one struct from step to step, which is copied whole.
    """
    item = F.col("item")
    in_first = item["in_first"]
    envelope = F.struct(*[_picked(item, c).alias(c) for c in ("space", "externalId", "external_id", *LIFECYCLE_COLUMNS)])
    properties = _picked(item, "properties")
    of_view = F.filter(F.map_values(properties), lambda views: views[view.view_key].isNotNull())
    entries = F.filter(
        F.when(in_first, item["a"]["sources"]),
        lambda e: _names(view, e["source"]["space"], e["source"]["externalId"], e["source"]["external_id"], e["source"]["version"]),
    )
    parts = items.select(
        "item",
        envelope.alias("envelope"),
        F.try_element_at(properties, F.lit(view.space))[view.view_key].alias("own"),
        of_view.alias("holders"),
        F.transform(entries, lambda e: e["properties"]).alias("entries"),
    )
    found = parts.select(
        item["record"].alias("record"),
        "envelope",
        (~in_first & item["b"][MISFIT].isNotNull()).alias("misfit"),
        in_first.alias("in_first"),
        item["a"].alias("a"),
        item["b"].alias("b"),
        F.when(F.col("own").isNotNull(), F.col("own")).otherwise(F.get("holders", 0)[view.view_key]).alias("nested"),
        (F.col("own").isNotNull() & (F.size("holders") > 1)).alias("may_fall_back"),
        F.get("entries", F.size("entries") - 1).alias("last"),
        F.get("entries", F.size("entries") - 2).alias("before"),
        (F.size("entries") > 2).alias("more_entries"),
    )
    keyed = F.when(~F.col("in_first"), F.col("b")["sources"][view.view_key])
    top = set(_top_level(view))
    values, flats = [], []
    for prop in view.properties:
        present = (lambda c: c) if read_as_text(prop) else _present
        candidates = [present(c[prop.source_key]) for c in (F.col("last"), F.col("before"), F.col("keyed"), F.col("nested"))]
        if prop in top:
            flat = F.when(F.col("in_first"), F.col("a")[prop.source_key]).otherwise(F.col("b")[prop.source_key])
            candidates.append(present(flat))
            flats.append(flat)
        values.append(F.coalesce(*candidates))
    # An own object without any value may be an empty one, and then another space's counts.
    some = [F.col("nested")[p.source_key].isNotNull() for p in view.properties]
    no_value = ~F.coalesce(F.greatest(*some) if len(some) > 1 else some[0], F.lit(False)) if some else F.lit(True)
    unsure = F.coalesce("more_entries", F.lit(False)) | (F.col("may_fall_back") & no_value)
    read = F.struct(*[v.alias(p.source_key) for p, v in zip(view.properties, values, strict=True)]) if values else F.struct(F.lit(None).alias("v"))
    if values:  # a nested object with nothing beside it is taken whole
        alone = [F.col("nested").isNotNull(), *[F.col(c).isNull() for c in ("last", "before", "keyed")], *[c.isNull() for c in flats]]
        read = F.when(_all(alone), F.col("nested")).otherwise(read)
    rows = found.withColumn("keyed", keyed).select("record", "envelope", "misfit", unsure.alias("unsure"), read.alias("read"))
    texts = {}
    for prop in view.properties:
        if read_as_text(prop):
            texts.setdefault((prop.spark_type, is_relation(prop)), []).append(F.col("read")[prop.source_key])
    unclear = [F.col("misfit"), F.col("unsure")]
    unclear += [unclear_texts(held, kind, F.col("record"), relation) for (kind, relation), held in texts.items()]
    any_unclear = ~_all([~F.coalesce(c, F.lit(False)) for c in unclear])
    return rows.select("record", "envelope", "read", any_unclear.alias("unclear"))


def _variant_values(rows: DataFrame, view: ViewDef) -> DataFrame:
    """``rows`` with the values of unclear rows as VARIANT in the struct ``reread`` (``s_0`` and so on) and their item in ``again``;
    both are NULL for other rows."""
    again = F.from_json(F.when(F.col("unclear"), F.col("record")), variant_schema(view))
    item = F.col("again")
    found = rows.select("envelope", "read", "unclear", again.alias("again")).select(
        "*",
        nested_object(item["properties"], view).alias("nested"),
        listed_objects(item["sources"], view).alias("listed"),
        F.try_variant_get(item["sources"], _json_path(view.view_key), "variant").alias("keyed"),
    )
    top, values = set(_top_level(view)), []
    for prop in view.properties:
        path = _json_path(prop.source_key)
        candidates = [
            F.when(F.col("listed").isNotNull(), _last_given(F.col("listed"), path)),
            _present(F.try_variant_get(F.col("keyed"), path, "variant")),
            _present(F.try_variant_get(F.col("nested"), path, "variant")),
        ]
        if prop in top:
            candidates.append(item[prop.source_key])
        values.append(F.coalesce(*candidates))
    reread = F.struct(*[v.alias(f"s_{i}") for i, v in enumerate(values)]) if values else F.struct(F.lit(None).alias("s"))
    return found.select("envelope", "read", "unclear", "again", F.when(F.col("unclear"), reread).alias("reread"))


def resolve(items: DataFrame, view: ViewDef) -> DataFrame:
    """The view's columns of each item. Non-null values in ``sources`` win over nested ones, these over top level.

    Unclear texts are coerced type by type in one array each, so that a view of hundreds of properties has a small plan.
    """
    rows = _variant_values(_typed_values(items, view), view)
    read, reread = (lambda i: F.col("read")[view.properties[i].source_key]), (lambda i: F.col("reread")[f"s_{i}"])
    numbered = list(enumerate(view.properties))
    of_type = {}
    for i, prop in numbered:
        if read_as_text(prop):
            of_type.setdefault(prop.spark_type, []).append(i)
    again, arrays, place = [], {}, {}
    for kind, held in of_type.items():
        arrays[kind] = f"again_{len(again)}"
        values = F.array(*[F.struct(reread(i).alias("value"), read(i).alias("raw")) for i in held])
        again.append(F.when(F.col("unclear"), coerce_list(values, kind)).alias(arrays[kind]))
        place.update({i: at for at, i in enumerate(held)})
    times = F.array(*[F.struct(F.col("again")[c].alias("value"), F.lit(None).cast("string").alias("raw")) for c in LIFECYCLE_COLUMNS])
    again.append(F.when(F.col("unclear"), coerce_list(times, T.TimestampType())).alias("again_times"))
    rows = rows.select("envelope", "read", "reread", "unclear", *again)

    item, unclear = F.col("envelope"), F.col("unclear")
    plain = {
        p.name: F.when(unclear, F.get(arrays[p.spark_type], F.lit(place[i]))).otherwise(from_plain_text(read(i), p.spark_type, is_relation(p)))
        for i, p in numbered if read_as_text(p)
    }
    plain["space"] = item["space"]
    plain["external_id"] = F.coalesce(F.nullif(item["externalId"], F.lit("")), item["external_id"])
    # Times of the envelope are texts only in records that don't fit.
    plain |= {c: F.when(unclear, F.get("again_times", F.lit(i))).otherwise(F.timestamp_millis(item[c])) for i, c in enumerate(LIFECYCLE_COLUMNS)}
    wanted = {
        p.name: (F.when(unclear, reread(i)).otherwise(_present(read(i))), p.spark_type)
        for i, p in numbered if not read_as_text(p)
    }
    if wanted:
        return coerce_columns(rows, wanted, plain=plain).select(*view.columns)
    # Texts that are their own value come from ``read``, which clear rows pass on whole; their fields are picked at the very end.
    own = {p.name: p for p in view.properties if isinstance(p.spark_type, T.StringType) and not is_relation(p)}
    texts = F.struct(*[
        (F.get(arrays[p.spark_type], F.lit(place[i])) if p.name in own else F.lit(None).cast("string")).alias(p.source_key) for i, p in numbered
    ] or [F.lit(None).alias("v")])
    texts = F.when(unclear, texts).otherwise(F.col("read"))
    whole = rows.select(F.struct(texts.alias("__texts"), *[plain[c].alias(c) for c in view.columns if c not in own]).alias("row"))
    # A generator, as in coerce_columns. It takes the row from the step below, which is compiled; a generator's own arguments aren't.
    made = whole.select(F.inline(F.array("row")))
    return made.select(*[F.col("__texts")[own[c].source_key].alias(c) if c in own else F.col(c) for c in view.columns])
