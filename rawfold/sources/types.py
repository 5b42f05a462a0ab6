"""One type for columns that differ between relations, down to the fields of nested arrays and structs.

The types form a lattice; ``common_type`` is the least type above all given ones:

* integers below floats; a decimal with a float is double, with an integer decimal(38, 9); dates below timestamps;
* two structs: a struct of the fields of both, by name (any case), each of its common type; a missing field is null;
* two arrays: an array of the elements' common type; an array and a single value (a nested object that a connector did not
  wrap): an array, the single value as its only element, null as null;
* two maps: a map of the common key and value types;
* anything else: string; nested values as JSON. Never a type whose cast fails on some value.

``convert`` casts where the difference is: fields are rebuilt and elements go through ``transform``; a part that has its type
already is left as it is.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WIDTH = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 3, T.LongType: 4, T.FloatType: 6, T.DoubleType: 7}
_MOMENTS = {T.TimestampType, T.TimestampNTZType, T.DateType}
_NESTED = (T.StructType, T.ArrayType, T.MapType)


def _two(a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.ArrayType) or isinstance(b, T.ArrayType):
        ea, eb = (t.elementType if isinstance(t, T.ArrayType) else t for t in (a, b))
        return T.ArrayType(_two(ea, eb), True)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        theirs = {f.name.lower(): f for f in b.fields}
        mine = {f.name.lower() for f in a.fields}
        fields = [T.StructField(f.name, _two(f.dataType, theirs[f.name.lower()].dataType) if f.name.lower() in theirs else f.dataType, True)
                  for f in a.fields]
        return T.StructType(fields + [T.StructField(f.name, f.dataType, True) for f in b.fields if f.name.lower() not in mine])
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(_two(a.keyType, b.keyType), _two(a.valueType, b.valueType), True)
    kinds = {type(a), type(b)}
    if kinds <= {*_WIDTH, T.DecimalType}:
        if T.DecimalType in kinds:
            return T.DoubleType() if kinds & {T.FloatType, T.DoubleType} else T.DecimalType(38, 9)
        return max((a, b), key=lambda t: _WIDTH[type(t)])
    if kinds <= _MOMENTS:
        return T.TimestampType() if T.TimestampType in kinds else T.TimestampNTZType()
    return T.StringType()


def common_type(types: list[T.DataType]) -> T.DataType:
    return reduce(_two, types)


def _cast_plain(src: T.DataType, to: T.DataType) -> bool:
    return not isinstance(src, _NESTED) and not isinstance(to, _NESTED)


def convert(c: Column, src: T.DataType, to: T.DataType) -> Column:
    """``c`` of type ``src`` as ``to``, a type above it."""
    if src == to:
        return c
    if isinstance(src, T.NullType) or _cast_plain(src, to):
        return c.cast(to)
    if isinstance(to, T.StringType):
        return F.to_json(c)
    if isinstance(to, T.ArrayType):
        if isinstance(src, T.ArrayType):
            return F.transform(c, lambda x: convert(x, src.elementType, to.elementType))
        return F.when(c.isNotNull(), F.array(convert(c, src, to.elementType)))
    if isinstance(to, T.StructType):
        have = {f.name.lower(): f for f in src.fields}
        fields = [(convert(c.getField(have[f.name.lower()].name), have[f.name.lower()].dataType, f.dataType) if f.name.lower() in have
                   else F.lit(None).cast(f.dataType)).alias(f.name) for f in to.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    return F.map_from_arrays(F.transform(F.map_keys(c), lambda x: convert(x, src.keyType, to.keyType)),
                             F.transform(F.map_values(c), lambda x: convert(x, src.valueType, to.valueType)))


def readable(src: T.DataType, to: T.DataType) -> bool:
    """Whether parquet files with ``src`` can be read as ``to``: the same, with new struct fields, or with wider whole numbers."""
    if isinstance(src, T.StructType) and isinstance(to, T.StructType):
        have = {f.name.lower(): f.dataType for f in src.fields}
        return all(f.name.lower() not in have or readable(have[f.name.lower()], f.dataType) for f in to.fields)
    if isinstance(src, T.ArrayType) and isinstance(to, T.ArrayType):
        return readable(src.elementType, to.elementType)
    if isinstance(src, T.MapType) and isinstance(to, T.MapType):
        return readable(src.keyType, to.keyType) and readable(src.valueType, to.valueType)
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    return src == to or (type(src) in whole and type(to) in whole and _WIDTH[type(src)] <= _WIDTH[type(to)])
