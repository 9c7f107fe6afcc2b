"""Versioned schema store and schema hints.

Versions live under ``<state>/_schemas/v=<n>/`` as one-line text files holding
``StructType.json()``.  They are written and read with Spark (Hadoop file
system), so the store works on any shared storage the cluster can see; the
listing ``_schemas/v=0, v=1, …`` is the inspectable version history.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from strata.sources import storage


def parse_ddl(spark: SparkSession, ddl: str) -> T.StructType:
    """``"a BIGINT, b STRING"`` (or ``a: BIGINT``) → StructType, parsed by Spark itself."""
    return spark.createDataFrame([], ddl).schema


_TOKEN = re.compile(r"`(?:[^`]|``)*`|[<>,:()]|[^`<>,:()\s]+")


def _type_of(tokens: list[str]) -> T.DataType:
    """One type off the front of ``schema_of_variant`` text; field names are tokens of their own, whatever they say.

    Fractions become DOUBLE, whole numbers beyond BIGINT too; an object without fields and conflicting types become
    STRING (the JSON text).  What was always NULL, or an array without elements, is still open: NullType.
    """
    word = tokens.pop(0)
    if word in ("OBJECT", "ARRAY"):
        tokens.pop(0)  # <
        if word == "ARRAY":
            inner = _type_of(tokens)
            tokens.pop(0)
            return T.ArrayType(inner, True)
        fields = []
        while tokens[0] != ">":
            name = tokens.pop(0)
            name = name[1:-1].replace("``", "`") if name[0] == "`" else name
            tokens.pop(0)  # :
            fields.append(T.StructField(name, _type_of(tokens), True))
            if tokens[0] == ",":
                tokens.pop(0)
        tokens.pop(0)
        return T.StructType(fields) if fields else T.StringType()
    if word == "DECIMAL":
        while tokens and tokens.pop(0) != ")":
            pass
        return T.DoubleType()
    known = {"BIGINT": T.LongType, "BOOLEAN": T.BooleanType, "DOUBLE": T.DoubleType, "FLOAT": T.DoubleType,
             "DATE": T.DateType, "TIMESTAMP": T.TimestampType, "TIMESTAMP_NTZ": T.TimestampNTZType,
             "BINARY": T.BinaryType, "VOID": T.NullType}
    return known.get(word, T.StringType)()


def is_open(dtype: T.DataType) -> bool:
    """Whether the data has not shown yet what this type is (all NULL, empty arrays)."""
    return isinstance(dtype, T.NullType) or isinstance(dtype, T.ArrayType) and is_open(dtype.elementType)


def _settled(dtype: T.DataType) -> T.DataType:
    """Without the open fields inside objects; they count as unknown keys until data shows their type.

    Of names that differ by case only, the first in the order of the text is a field; the others stay unknown keys.
    """
    if isinstance(dtype, T.StructType):
        first: dict[str, T.StructField] = {}
        for f in dtype.fields:
            if not is_open(f.dataType):
                first.setdefault(f.name.lower(), T.StructField(f.name, _settled(f.dataType), True))
        kept = list(first.values())
        return T.StructType(kept) if kept else T.StringType()
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_settled(dtype.elementType), True)
    return dtype


def schema_from_variant_type(spark: SparkSession, t: str | None) -> T.StructType:
    """``OBJECT<a: BIGINT, …>`` → StructType (empty for NULL / non-object)."""
    if not t or not t.startswith("OBJECT<"):
        return T.StructType([])
    found = _settled(_type_of(_TOKEN.findall(t)))
    return found if isinstance(found, T.StructType) else T.StructType([])


def all_strings(schema: T.StructType) -> T.StructType:
    """``inferColumnTypes=false``: every top-level column is a STRING (objects as JSON text)."""
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])


def apply_hints(spark: SparkSession, schema: T.StructType, hints: str | None) -> T.StructType:
    """Override types by (case-insensitive) name; hinted columns not yet seen are appended."""
    if not hints:
        return schema
    hinted = {f.name.lower(): f for f in parse_ddl(spark, hints).fields}
    out = [T.StructField(f.name, hinted.pop(f.name.lower()).dataType, True) if f.name.lower() in hinted else f
           for f in schema.fields]
    return T.StructType(out + [T.StructField(f.name, f.dataType, True) for f in hinted.values()])


def _extends(new: T.DataType, old: T.DataType) -> bool:
    """Whether ``new`` is ``old``, perhaps with more fields inside its objects: what was written as old reads as new."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        types = {f.name: f.dataType for f in new.fields}
        return all(f.name in types and _extends(types[f.name], f.dataType) for f in old.fields)
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return _extends(new.elementType, old.elementType)
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        return new.keyType == old.keyType and _extends(new.valueType, old.valueType)
    return new == old


def check_types_kept(old: T.StructType, new: T.StructType) -> None:
    """A stored column keeps its type: batches written under it are read by it.  Its objects may get more fields."""
    types = {f.name.lower(): f.dataType for f in old.fields}
    changed = [f.name for f in new.fields if f.name.lower() in types and not _extends(f.dataType, types[f.name.lower()])]
    if changed:
        raise ValueError(f"columns {changed} are stored with another type; hint them before the first batch, or reset")


class SchemaStore:
    """``latest()`` / ``write(schema)`` over ``<location>/_schemas``."""

    def __init__(self, spark: SparkSession, location: str):
        self.spark = spark
        self.path = f"{location.rstrip('/')}/_schemas"

    def versions(self) -> list[tuple[int, T.StructType]]:
        if not storage.exists(self.spark, self.path):
            return []
        rows = self.spark.read.schema("value string, v int").text(self.path).orderBy("v").collect()
        return [(int(r["v"]), T.StructType.fromJson(json.loads(r["value"]))) for r in rows]

    def latest(self) -> tuple[int, T.StructType] | None:
        found = self.versions()  # a version per change of the schema
        return found[-1] if found else None

    def accept(self, schema: T.StructType | str) -> int:
        """A person's decision: ``schema`` (or DDL text) becomes the next version and holds from the next run on."""
        schema = parse_ddl(self.spark, schema) if isinstance(schema, str) else schema
        latest = self.latest()
        version = latest[0] + 1 if latest else 0
        if latest:
            check_types_kept(latest[1], schema)
        self.write(version, schema)
        return version

    def write(self, version: int, schema: T.StructType) -> None:
        (self.spark.createDataFrame([(schema.json(),)], "value string").coalesce(1)
         .write.mode("overwrite").text(f"{self.path}/v={version}"))
