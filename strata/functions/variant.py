"""Typed projection of parsed JSON with a rescue column.

Input rows carry the raw line and ``_v`` (``try_parse_json(line)``, VARIANT,
NULL when the line is not valid JSON).  A value that is present but does not
convert *losslessly* — at any depth, e.g. one element of ``items`` with
``qty: "x"``, a fraction under an integer type, a number under BOOLEAN, a time of day under DATE, a nested
key the schema does not know — is kept whole in the rescue column, and its typed
column has NULL in place of what would have been changed.  Unknown top-level keys
are rescued as well.  Lines that are not JSON objects go to the
rescue column verbatim.  All of it is built-in expressions: nothing leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def field_value(x: Column, name: str, kind: str = "variant") -> Column:
    """Field ``name`` of an object; a name with both kinds of quotes has no path and is looked up as a key."""
    if "'" not in name:
        return F.try_variant_get(x, f"$['{name}']", kind)
    if '"' not in name:
        return F.try_variant_get(x, f'$["{name}"]', kind)
    return F.try_variant_get(F.get(F.map_values(F.map_filter(
        F.try_variant_get(x, "$", "map<string,variant>"), lambda k, _: k == name)), F.lit(0)), "$", kind)


def _absent(x: Column) -> Column:
    return x.isNull() | F.is_variant_null(x)


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def _text_lossless(text: Column, typed: Column, dtype: T.DataType) -> Column:
    """Whether a string says no more than its typed value: the value written back is the string in its plain form.

    Plain form: outer blanks and a boolean's case do not count; a number is the same number (an integer the same digits);
    a date has no time of day; a time without seconds has none, a date alone is its midnight, zeros at the end of a
    fraction say nothing; TIMESTAMP_NTZ has no zone.  TIMESTAMP keeps the instant, so a zone is allowed there.
    """
    plain = F.trim(text)
    back = typed.cast("string")
    if isinstance(dtype, T.BooleanType):
        return F.lower(plain) == back
    if isinstance(dtype, _INTEGRAL):
        return plain == back
    if isinstance(dtype, _FRACTIONAL):
        said, kept = plain.try_cast("decimal(38,18)"), back.try_cast("decimal(38,18)")
        # beyond a decimal: up to 15 digits survive in a double, 6 in a float
        digits = F.length(F.regexp_replace(F.regexp_replace(F.lower(plain), "e.*$", ""), "[^0-9]|^[-+]?[0.]+", ""))
        short = (digits <= (6 if isinstance(dtype, T.FloatType) else 15)) & ~back.contains("Infinity")
        exponent = F.lower(plain).contains("e") & F.lit(not isinstance(dtype, T.DecimalType)) & short
        return (plain == back) | exponent | F.coalesce(said == kept, F.lit(False))
    if isinstance(dtype, T.DateType):
        return plain == back
    spaced = F.regexp_replace(plain, "^(\\d{4}-\\d{1,2}-\\d{1,2})[Tt]", "$1 ")
    if isinstance(dtype, T.TimestampNTZType):
        full = F.when(spaced.rlike("^\\d{4}-\\d{1,2}-\\d{1,2}$"), F.concat(spaced, F.lit(" 00:00:00"))) \
            .when(spaced.rlike("^\\S+ \\d{1,2}:\\d{2}$"), F.concat(spaced, F.lit(":00"))).otherwise(spaced)
        return F.regexp_replace(F.regexp_replace(full, "(\\.\\d*?)0+$", "$1"), "\\.$", "") == back
    if isinstance(dtype, T.TimestampType):
        return ~plain.rlike("\\.\\d{6}0*[1-9]")  # finer than a microsecond
    return F.lit(True)


def _scalar_lossless(x: Column, dtype: T.DataType) -> Column:
    """The value's own type decides: a number stays the same number, a boolean a boolean; a string may be parsed (H3) if
    its typed value says all that it says."""
    own = F.schema_of_variant(x)
    typed = F.try_variant_get(x, "$", dtype.simpleString())
    text = (own == "STRING") & F.coalesce(_text_lossless(F.try_variant_get(x, "$", "string"), typed, dtype), F.lit(False))
    if isinstance(dtype, T.BooleanType):
        fits = text | (own == "BOOLEAN")
    elif isinstance(dtype, _INTEGRAL + _FRACTIONAL):
        exact = F.try_variant_get(x, "$", "decimal(38,18)")
        same = typed.try_cast("decimal(38,18)") == exact
        number = (own == "BIGINT") | own.startswith("DECIMAL")
        if isinstance(dtype, _INTEGRAL):
            fits = text | ((number | (own == "DOUBLE")) & same)
        else:
            # a JSON fraction is read as the nearest double; a whole number must survive the way there and back
            fraction = number & (own != "BIGINT") & ~F.lit(isinstance(dtype, T.DecimalType))
            fits = text | (own == "DOUBLE") | fraction | (number & same)
    else:
        fits = text | own.startswith("TIMESTAMP") | (own == "DATE")
    return _absent(x) | F.coalesce(fits & typed.isNotNull(), F.lit(False))


def lossless(x: Column, dtype: T.DataType) -> Column:
    """TRUE when variant ``x`` is absent/null or converts to ``dtype`` without losing anything."""
    if isinstance(dtype, T.StructType):
        as_map = F.try_variant_get(x, "$", "map<string,variant>")
        known = F.array(*[F.lit(f.name) for f in dtype.fields])
        ok = as_map.isNotNull() & (F.size(F.array_except(F.map_keys(as_map), known)) == 0)
        for f in dtype.fields:
            ok = ok & lossless(field_value(x, f.name), f.dataType)
        return _absent(x) | F.coalesce(ok, F.lit(False))
    if isinstance(dtype, T.ArrayType):
        arr = F.try_variant_get(x, "$", "array<variant>")
        et = dtype.elementType
        return _absent(x) | F.coalesce(F.forall(arr, lambda e: lossless(e, et)), F.lit(False))
    if isinstance(dtype, T.MapType):
        m = F.try_variant_get(x, "$", "map<string,variant>")
        vt = dtype.valueType
        return _absent(x) | F.coalesce(F.forall(F.map_values(m), lambda e: lossless(e, vt)), F.lit(False))
    if isinstance(dtype, T.StringType):
        return F.lit(True)  # anything has a string form
    return _scalar_lossless(x, dtype)


def faithful(x: Column, dtype: T.DataType) -> Column:
    """The typed value of ``x`` with NULL in place of each scalar that would not convert losslessly, at any depth."""
    if isinstance(dtype, T.StructType):
        fields = [faithful(field_value(x, f.name), f.dataType).alias(f.name)
                  for f in dtype.fields]
        is_object = F.try_variant_get(x, "$", "map<string,variant>").isNotNull()
        return F.when(is_object, F.struct(*fields)).cast(dtype)
    if isinstance(dtype, T.ArrayType):
        et = dtype.elementType
        return F.transform(F.try_variant_get(x, "$", "array<variant>"), lambda e: faithful(e, et)).cast(dtype)
    if isinstance(dtype, T.MapType):
        vt = dtype.valueType
        return F.transform_values(F.try_variant_get(x, "$", "map<string,variant>"), lambda _, e: faithful(e, vt))
    return F.when(lossless(x, dtype), F.try_variant_get(x, "$", dtype.simpleString()))


def fit_flags(schema: T.StructType, v: str) -> Column:
    """Per schema field, in order, whether its value is lossless (evaluated once; read by the two below)."""
    return F.array(*[lossless(field_value(F.col(v), f.name), f.dataType)
                     for f in schema.fields] or [F.lit(True)])


def typed_columns(schema: T.StructType, v: str, fits: str) -> list[Column]:
    """Each field as its type: in one step where it fits, piece by piece (NULL for what does not) where not."""
    out = []
    for i, f in enumerate(schema.fields):
        whole = field_value(F.col(v), f.name, _ddl(f.dataType))
        parts = faithful(field_value(F.col(v), f.name), f.dataType)
        out.append(F.when(F.get(fits, F.lit(i)), whole).otherwise(parts).alias(f.name))
    return out


def _ddl(dtype: T.DataType) -> str:
    """Type text with quoted field names (names may hold any character)."""
    if isinstance(dtype, T.StructType):
        inner = ",".join(f"`{f.name.replace('`', '``')}`:{_ddl(f.dataType)}" for f in dtype.fields)
        return f"struct<{inner}>"
    if isinstance(dtype, T.ArrayType):
        return f"array<{_ddl(dtype.elementType)}>"
    if isinstance(dtype, T.MapType):
        return f"map<{_ddl(dtype.keyType)},{_ddl(dtype.valueType)}>"
    return dtype.simpleString()


def _readable(dtype: T.DataType) -> bool:
    """Types whose values a JSON reader takes from their own kind of token only, and that are written back alike."""
    if isinstance(dtype, T.StructType):
        return all(_readable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _readable(dtype.elementType)
    return isinstance(dtype, (T.StringType, T.LongType, T.DoubleType, T.BooleanType))


_AS_TEXT = (T.DateType, T.TimestampType, T.TimestampNTZType)  # read as text, then cast


def read_whole(schema: T.StructType, raw: str, order: Sequence[str] = ()) -> Column | None:
    """The whole line as one object of the schema's fields (dates and times as text), or None if a type rules that out.

    ``order`` names fields in the order in which lines are likely to have them: what ``says_all`` compares is in it.
    """
    if not schema.fields or not all(_readable(f.dataType) or isinstance(f.dataType, _AS_TEXT) for f in schema.fields):
        return None
    place = {n: i for i, n in enumerate(order)}
    fields = sorted(schema.fields, key=lambda f: place.get(f.name, len(place)))
    as_read = [T.StructField(f.name, T.StringType() if isinstance(f.dataType, _AS_TEXT) else f.dataType, True)
               for f in fields]
    return F.from_json(raw, T.StructType(as_read))


def says_all(schema: T.StructType, raw: str, whole: str) -> Column:
    """TRUE when the object, written as JSON, is the line byte for byte: then the line holds no other key, no value of
    another kind and none that was changed on the way.  FALSE says nothing; ``fit_flags`` decides then."""
    line = F.col(raw)
    ok = F.to_json(F.col(whole), {"ignoreNullFields": "true"}) == line
    for before in ":,[":  # -0.0 is 0.0 in a VARIANT
        ok = ok & ~line.contains(f"{before}-0")
    ok = ok & ~line.contains('"NaN"') & ~line.contains('Infinity"')  # text that a reader takes for a number
    ok = ok & (F.octet_length(line) < 1 << 20)  # a VARIANT's size has a limit
    for f in schema.fields:
        if isinstance(f.dataType, _AS_TEXT):
            text = F.col(whole).getField(f.name)
            typed = text.try_cast(f.dataType)
            ok = ok & (text.isNull() | (typed.isNotNull() & _text_lossless(text, typed, f.dataType)))
    return F.coalesce(ok, F.lit(False))


def whole_columns(schema: T.StructType, whole: str) -> list[Column]:
    """The fields of an object that ``says_all``."""
    return [F.col(whole).getField(f.name).try_cast(f.dataType) if isinstance(f.dataType, _AS_TEXT)
            else F.col(whole).getField(f.name) for f in schema.fields]


def rescued_column(schema: T.StructType, raw: str, v: str, fits: str, rescue_unknown: bool = True) -> Column:
    """JSON text of every field that the typed columns do not hold faithfully; NULL when nothing is lost.

    A field that does not fit is kept whole, with keys inside it that the schema does not know.  ``fits`` is the
    column of ``fit_flags``; ``rescue_unknown`` also keeps unknown top-level keys.
    """
    names = [f.name for f in schema.fields]
    known = F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>")
    bad = F.array_compact(F.array(*[F.when(~F.get(fits, F.lit(i)), F.lit(n)) for i, n in enumerate(names)]
                                  or [F.lit(None).cast("string")]))
    is_object = F.col(v).isNotNull() & F.ltrim(F.col(raw)).startswith("{")
    as_map = F.try_variant_get(F.col(v), "$", "map<string,variant>")
    if rescue_unknown:
        lost = F.array_union(bad, F.array_except(F.map_keys(as_map), known))
    else:
        lost = bad
    picked = F.to_json(F.map_filter(as_map, lambda k, _: F.array_contains(lost, k)))
    return F.when(~is_object, F.col(raw)).when(F.size(lost) > 0, picked)
