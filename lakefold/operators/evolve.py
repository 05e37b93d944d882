"""Schemas that change between batches (M7, K1).

Two schemas are merged field by field, through structs, arrays and maps:
fields that one side lacks are added, and types meet at the lowest type that
holds both sides:

    byte < short < int < long < decimal < double < string
    float < double,  date < timestamp,  anything scalar < string

An integer and a float meet at double.  ``conform`` writes the rows of
either side in the merged schema as one projection; a side that has it
already is returned as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaMergeError(ValueError):
    """Two types have no common one: a struct, array or map meets something else."""


_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_DIGITS = dict(zip(map(type, _WHOLE), (3, 5, 10, 19)))
_NESTED = (T.StructType, T.ArrayType, T.MapType)
_MOMENTS = (T.TimestampType, T.TimestampNTZType)
_TEXT = (T.StringType, T.CharType, T.VarcharType)


def _decimal(t: T.DataType) -> T.DecimalType | None:
    if isinstance(t, T.DecimalType):
        return t
    return T.DecimalType(_DIGITS[type(t)], 0) if type(t) in _DIGITS else None


def merge_types(a: T.DataType, b: T.DataType, where: str = "") -> T.DataType:
    """The lowest type that holds the values of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, _NESTED) or isinstance(b, _NESTED):
        if type(a) is not type(b):
            raise SchemaMergeError(f"{where or 'column'}: {a.simpleString()} and {b.simpleString()} have no common type")
        if isinstance(a, T.StructType):
            return merge_schemas(a, b, where)
        if isinstance(a, T.ArrayType):
            return T.ArrayType(merge_types(a.elementType, b.elementType, f"{where}[]"), True)
        return T.MapType(merge_types(a.keyType, b.keyType, f"{where}.key"), merge_types(a.valueType, b.valueType, f"{where}.value"), True)
    if type(a) in _DIGITS and type(b) in _DIGITS:
        return max(a, b, key=lambda t: _DIGITS[type(t)])
    one, two = _decimal(a), _decimal(b)
    if one and two:
        scale = max(one.scale, two.scale)
        precision = max(one.precision - one.scale, two.precision - two.scale) + scale
        return T.DecimalType(precision, scale) if precision <= 38 else T.DoubleType()
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    if {type(a), type(b)} <= {T.DateType, *_MOMENTS}:
        return next((t for t in (a, b) if isinstance(t, T.TimestampType)), T.TimestampNTZType())
    return T.StringType()


def merge_schemas(a: T.StructType, b: T.StructType, where: str = "") -> T.StructType:
    """``a``'s fields in their order, then the new ones of ``b``; names are
    compared without regard to case, as Spark does."""
    of_b = {f.name.lower(): f for f in b.fields}
    out = [T.StructField(f.name, merge_types(f.dataType, of_b[f.name.lower()].dataType, f"{where}.{f.name}".lstrip("."))
                         if f.name.lower() in of_b else f.dataType, True) for f in a.fields]
    known = {f.name.lower() for f in a.fields}
    return T.StructType(out + [T.StructField(f.name, f.dataType, True) for f in b.fields if f.name.lower() not in known])


def _shape(t: T.DataType) -> T.DataType:
    """The type with everything nullable."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _shape(f.dataType), True) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_shape(t.elementType), True)
    if isinstance(t, T.MapType):
        return T.MapType(_shape(t.keyType), _shape(t.valueType), True)
    return t


def same_type(a: T.DataType, b: T.DataType) -> bool:
    """Equal but for nullability."""
    return _shape(a) == _shape(b)


def conform_column(col: Column, have: T.DataType, want: T.DataType) -> Column:
    if same_type(have, want):
        return col
    if isinstance(want, T.StructType):
        own = {f.name.lower(): f for f in have.fields}
        fields = [conform_column(col[own[f.name.lower()].name], own[f.name.lower()].dataType, f.dataType) if f.name.lower() in own
                  else F.lit(None).cast(f.dataType) for f in want.fields]
        return F.when(col.isNotNull(), F.struct(*[c.alias(f.name) for c, f in zip(fields, want.fields)]))
    if isinstance(want, T.ArrayType):
        return F.transform(col, lambda x: conform_column(x, have.elementType, want.elementType))
    if isinstance(want, T.MapType):
        return F.map_from_entries(F.transform(F.map_entries(col), lambda e: F.struct(
            conform_column(e["key"], have.keyType, want.keyType).alias("key"),
            conform_column(e["value"], have.valueType, want.valueType).alias("value"))))
    return col.cast(want)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema`` in their order and types; a
    column that ``df`` lacks is null."""
    own = {f.name.lower(): f for f in df.schema.fields}
    if [f.name for f in df.schema.fields] == schema.fieldNames() and same_type(df.schema, schema):
        return df
    return df.select(*[
        (conform_column(df[f"`{own[f.name.lower()].name}`"], own[f.name.lower()].dataType, f.dataType) if f.name.lower() in own
         else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


def conform_both(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides, each with its own columns, those that they share in the
    merged type."""
    merged = {f.name.lower(): f for f in merge_schemas(a.schema, b.schema).fields}

    def own(df: DataFrame) -> DataFrame:
        return conform(df, T.StructType([T.StructField(f.name, merged[f.name.lower()].dataType, True) for f in df.schema.fields]))

    return own(a), own(b)


#: Changes of a stored type that Spark's Parquet reader makes itself.
_READABLE = {(T.ByteType, t) for t in (T.ShortType, T.IntegerType, T.LongType, T.DoubleType)} | {
    (T.ShortType, t) for t in (T.IntegerType, T.LongType, T.DoubleType)} | {
    (T.IntegerType, T.LongType), (T.IntegerType, T.DoubleType), (T.FloatType, T.DoubleType)}


def readable_as(stored: T.DataType, wanted: T.DataType) -> bool:
    """Whether files written with ``stored`` can be read as ``wanted``: added
    fields read as null, and whole numbers and floats widen."""
    if isinstance(stored, T.StructType) and isinstance(wanted, T.StructType):
        of = {f.name.lower(): f.dataType for f in wanted.fields}
        return all(f.name.lower() in of and readable_as(f.dataType, of[f.name.lower()]) for f in stored.fields)
    if isinstance(stored, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return readable_as(stored.elementType, wanted.elementType)
    if isinstance(stored, T.MapType) and isinstance(wanted, T.MapType):
        return readable_as(stored.keyType, wanted.keyType) and readable_as(stored.valueType, wanted.valueType)
    return stored == wanted or (type(stored), type(wanted)) in _READABLE
