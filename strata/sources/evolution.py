"""Nested schema evolution (S7): new fields inside objects that the schema already has.

A *place* is a struct of the schema, named by the steps from the line to it: a field's name, ``EACH`` for the
elements of an array, ``VALUES`` for the values of a map.  Two distributed passes find what is new: the first
collects the names of unseen keys of every place (names only; they are the schema's own size), the second, which
runs only when there are some, infers their types, all places in one aggregate.  Types that are stored never
change: a value under a known key that does not fit stays in the rescue column, and an object under a key that is
stored as text or a number adds nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.variant import field_value
from strata.sources.schema_store import parse_ddl, schema_from_variant_type

EACH, VALUES = "[]", "{}"  # steps are (name, is_field) pairs, so a field may be called either


def places(dtype: T.DataType, at: tuple = ()) -> dict[tuple, T.StructType]:
    """Every struct of the type by its steps, the outermost first."""
    if isinstance(dtype, T.StructType):
        found = {at: dtype}
        for f in dtype.fields:
            found |= places(f.dataType, (*at, (f.name, True)))
        return found
    if isinstance(dtype, T.ArrayType):
        return places(dtype.elementType, (*at, (EACH, False)))
    if isinstance(dtype, T.MapType):
        return places(dtype.valueType, (*at, (VALUES, False)))
    return {}


def path_text(at: tuple, name: str) -> str:
    """``items[].note`` for a reader of the error."""
    text = ""
    for step, is_field in at:
        text += f".{step}" if is_field and text else step
    return f"{text}.{name}" if text else name


def _values_at(x: Column, at: tuple) -> Column:
    """All values of a place in one line, as an array."""
    if not at:
        return F.array(x)
    outer, (name, is_field) = _values_at(x, at[:-1]), at[-1]
    if is_field:
        return F.transform(outer, lambda v: field_value(v, name))
    if name == EACH:
        inner = F.transform(outer, lambda v: F.try_variant_get(v, "$", "array<variant>"))
    else:
        inner = F.transform(outer, lambda v: F.map_values(F.try_variant_get(v, "$", "map<string,variant>")))
    return F.flatten(F.array_compact(inner))


def _objects_at(x: Column, at: tuple) -> Column:
    """The place's objects in one line, each as a map; values of other kinds are left out."""
    return F.array_compact(F.transform(_values_at(x, at), lambda v: F.try_variant_get(v, "$", "map<string,variant>")))


def _tagged(place: int, values: Column, name: str) -> Column:
    """Array of (place, value)."""
    return F.transform(values, lambda x: F.struct(F.lit(place).alias("place"), x.alias(name)))


def _fresh_names(x: Column, at: tuple, struct: T.StructType) -> Column:
    names = F.array_distinct(F.flatten(F.transform(_objects_at(x, at), F.map_keys)))
    known = [f.name.lower() for f in struct.fields]
    return F.filter(names, lambda k: ~F.lower(k).isin(known))


def _only(x: Column, at: tuple, keys: list[str]) -> Column:
    """The place's objects without the fields that are known."""
    return F.transform(_objects_at(x, at), lambda m: F.to_variant_object(F.map_filter(m, lambda k, _: k.isin(keys))))


def new_keys(objects: DataFrame, v: str, schema: T.StructType, skip=()) -> dict[tuple, list[str]]:
    """Unseen keys (case-insensitive) by place; top-level columns in ``skip`` are not looked into."""
    found = {at: s for at, s in places(schema).items() if not at or at[0][0].lower() not in skip}
    names = [_tagged(i, _fresh_names(F.col(v), at, struct), "k") for i, (at, struct) in enumerate(found.items())]
    rows = objects.select(F.explode(F.concat(*names)).alias("new")).select("new.*").distinct().collect()
    at = list(found)
    out: dict[tuple, list[str]] = {}
    for r in sorted(rows):
        out.setdefault(at[r["place"]], []).append(r["k"])
    return out


def new_fields(spark: SparkSession, objects: DataFrame, v: str, fresh: dict[tuple, list[str]]) -> dict[tuple, T.StructType]:
    """Types of the fresh keys by place; keys whose type no value has shown are left out."""
    parts = [_tagged(i, _only(F.col(v), at, keys), "o") for i, (at, keys) in enumerate(fresh.items())]
    types = (objects.select(F.explode(F.concat(*parts)).alias("part"))
             .groupBy("part.place").agg(F.schema_of_variant_agg("part.o").alias("t")).collect())
    at = list(fresh)
    found = {at[r["place"]]: schema_from_variant_type(spark, r["t"]) for r in types}
    return {place: struct for place, struct in found.items() if struct.fields}


def widened(dtype: T.DataType, added: dict[tuple, T.StructType], at: tuple = ()) -> T.DataType:
    """The type with the added fields at the end of their structs; all else as it was."""
    if isinstance(dtype, T.StructType):
        fields = [T.StructField(f.name, widened(f.dataType, added, (*at, (f.name, True))), f.nullable) for f in dtype.fields]
        return T.StructType(fields + (added[at].fields if at in added else []))
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(widened(dtype.elementType, added, (*at, (EACH, False))), dtype.containsNull)
    if isinstance(dtype, T.MapType):
        return T.MapType(dtype.keyType, widened(dtype.valueType, added, (*at, (VALUES, False))), dtype.valueContainsNull)
    return dtype


def hinted_columns(spark: SparkSession, hints: str | None) -> set[str]:
    """Columns whose type a person has fixed."""
    return {f.name.lower() for f in parse_ddl(spark, hints).fields} if hints else set()
