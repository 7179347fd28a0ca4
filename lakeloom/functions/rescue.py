"""Fields that do not fit a declared schema, kept as JSON text beside the ones that do."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESCUED = "_rescued_data"
# Member of the rescued text that holds a line which is no JSON object.
CORRUPT = "_corrupt_record"


def _object(entries: Column) -> Column:
    """The entries of a map that hold anything, as a variant; NULL without any."""
    held = F.map_filter(entries, lambda _, v: v.isNotNull())
    return F.when(F.size(held) > 0, F.to_variant_object(held))


def _map(pairs: dict[str, Column]) -> Column:
    if not pairs:
        return F.create_map().cast("map<string,variant>")
    return F.create_map(*[x for name, value in pairs.items() for x in (F.lit(name), value)])


def left_over(raw: Column, value: Column, kind: T.DataType) -> Column:
    """What of the variant ``raw`` is not in ``value``, the same JSON read as ``kind``; NULL if nothing is missing.

    Members of structs are looked at one by one, at any depth: undeclared names (spelling counts) and values whose type
    does not fit are kept as they came. Of arrays and maps the entries that lost something are kept at their place or key.
    """
    whole = F.when(value.isNull() & ~F.is_variant_null(raw), raw)
    if isinstance(kind, T.StructType):
        members = F.try_variant_get(raw, "$", "map<string,variant>")
        known = _map({f.name: left_over(members[f.name], value.getField(f.name), f.dataType) for f in kind})
        names = [f.name for f in kind]
        unknown = F.map_filter(members, lambda k, v: ~k.isin(names) & v.isNotNull()) if names else members
        parts = _object(F.map_concat(unknown, F.map_filter(known, lambda _, v: v.isNotNull())))
        return F.when(members.isNull() | value.isNull(), whole).otherwise(parts)
    if isinstance(kind, T.ArrayType):
        items = F.try_variant_get(raw, "$", "array<variant>")
        lost = F.transform(items, lambda x, i: left_over(x, F.get(value, i), kind.elementType))
        parts = F.when(F.exists(lost, lambda x: x.isNotNull()), F.to_variant_object(lost))
        return F.when(items.isNull() | value.isNull(), whole).otherwise(parts)
    if isinstance(kind, T.MapType):
        members = F.try_variant_get(raw, "$", "map<string,variant>")
        lost = F.transform_values(members, lambda k, v: left_over(v, F.element_at(value, k), kind.valueType))
        return F.when(members.isNull() | value.isNull(), whole).otherwise(_object(lost))
    return whole


def rescued_fields(lines: DataFrame, schema: T.StructType | str, text: str = "value", name: str = RESCUED) -> DataFrame:
    """JSON text in a column as declared columns and ``name``, the JSON text of all that did not fit; the text column goes.

    A row whose fields all fit has NULL in ``name``. A line that is no JSON object has NULL in all declared columns and stands
    whole under ``_corrupt_record``. The work is one projection, so it is the same over a stream and over a table.
    """
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    line = F.col(f"`{text}`")
    others = [c for c in lines.columns if c != text]
    taken = {*others, name} & {f.name for f in kind}
    if taken:
        raise ValueError(f"declared columns clash with {sorted(taken)}")
    read = lines.select(*[F.col(f"`{c}`") for c in others], line.alias("_line"), F.from_json(line, kind).alias("_read"), F.try_parse_json(line).alias("_raw"))
    is_object = F.try_variant_get(F.col("_raw"), "$", "map<string,variant>").isNotNull()
    odd = F.when(F.col("_line").isNotNull(), F.to_json(F.struct(F.col("_line").alias(CORRUPT))))
    kept = F.when(is_object, F.to_json(left_over(F.col("_raw"), F.col("_read"), kind))).otherwise(odd)
    fields = [F.when(is_object, F.col(f"_read.`{f.name}`")).alias(f.name) for f in kind]
    return read.select(*[F.col(f"`{c}`") for c in others], *fields, kept.alias(name))


def rescued_columns(df: DataFrame, schema: T.StructType | str, name: str = RESCUED) -> DataFrame:
    """Declared columns of typed files (missing ones NULL), and all others that hold a value as JSON text in ``name``.

    For files whose columns came and went: read them with the schema of all (``mergeSchema``) first.
    """
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    declared = {f.name for f in kind}
    others = [F.col(f"`{c}`") for c in df.columns if c not in declared]
    held = reduce(Column.__or__, [c.isNotNull() for c in others], F.lit(False))
    kept = F.when(held, F.to_json(F.struct(*others))) if others else F.lit(None).cast("string")
    fields = [F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in kind]
    return df.select(*fields, kept.alias(name))
