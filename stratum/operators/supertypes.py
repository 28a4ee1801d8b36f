"""Unions of frames whose types drift apart: each column gets the narrowest type that holds all of its values.

The lattice: booleans below integers; integers by width; integers and decimals
meet in a decimal with room for both, or in double where 38 digits don't do;
integers and floating-point numbers meet in double (as do 64-bit integers, of
which it holds 53 bits), except that integers of 16 bits fit in float; dates
below timestamps; arrays and maps by their elements, structs field by field (a
field that one side lacks is null); text is above everything, with nested values
as JSON.  A column of nulls only takes any type.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
#: Decimal digits of the integers above.
_DIGITS = (3, 5, 10, 19)
_NESTED = (T.ArrayType, T.StructType, T.MapType)
_TIMES = (T.DateType, T.TimestampNTZType, T.TimestampType)


def _decimal(kind: T.DataType) -> T.DecimalType | None:
    """The decimal that holds all values of an exact number type."""
    if isinstance(kind, T.DecimalType):
        return kind
    return T.DecimalType(_DIGITS[_INTEGERS.index(type(kind))], 0) if type(kind) in _INTEGERS else None


def _number(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The common type of two numbers, or None."""
    if isinstance(a, T.BooleanType) and isinstance(b, T.NumericType):
        return b
    if isinstance(b, T.BooleanType) and isinstance(a, T.NumericType):
        return a
    if type(a) in _INTEGERS and type(b) in _INTEGERS:
        return max(a, b, key=lambda x: _INTEGERS.index(type(x)))
    x, y = _decimal(a), _decimal(b)
    if x is not None and y is not None:
        scale = max(x.scale, y.scale)
        whole = max(x.precision - x.scale, y.precision - y.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        other = b if isinstance(a, T.FloatType) else a if isinstance(b, T.FloatType) else None
        return T.FloatType() if type(other) in _INTEGERS[:2] else T.DoubleType()
    return None


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if (number := _number(a, b)) is not None:
        return number
    if type(a) in _TIMES and type(b) in _TIMES:
        return max(a, b, key=lambda x: _TIMES.index(type(x)))
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType), a.containsNull or b.containsNull)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(common_type(a.keyType, b.keyType), common_type(a.valueType, b.valueType), a.valueContainsNull or b.valueContainsNull)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        have = {f.name: f for f in b.fields}
        fields = [T.StructField(f.name, common_type(f.dataType, have[f.name].dataType) if f.name in have else f.dataType) for f in a.fields]
        return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in b.fields if f.name not in a.names])
    return T.StringType()


def widen(column: Column, have: T.DataType, want: T.DataType) -> Column:
    """A column in a type above its own."""
    if have == want:
        return column
    if isinstance(want, T.StringType):
        return F.to_json(column) if isinstance(have, _NESTED) else column.cast("string")
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(column, lambda x: widen(x, have.elementType, want.elementType)).cast(want)
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        entries = F.transform(F.map_entries(column), lambda x: F.struct(widen(x["key"], have.keyType, want.keyType).alias("key"), widen(x["value"], have.valueType, want.valueType).alias("value")))
        return F.map_from_entries(entries).cast(want)
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        own = {f.name: f.dataType for f in have.fields}
        fields = [(widen(column.getField(f.name), own[f.name], f.dataType) if f.name in own else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields]
        return F.when(column.isNotNull(), F.struct(*fields)).cast(want)
    return column.cast(want)


def common_schema(schemas: Sequence[T.StructType]) -> T.StructType:
    """Columns of all schemas, in the order in which they first occur, in their common types."""
    return reduce(common_type, schemas)


def widened_union(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames by column name in their common types; columns that a frame lacks are null."""
    schema = common_schema([f.schema for f in frames])

    def fitted(frame: DataFrame) -> DataFrame:
        have = {f.name: f.dataType for f in frame.schema.fields}
        quoted = lambda name: F.col("`" + name.replace("`", "``") + "`")
        return frame.select(*((widen(quoted(f.name), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields))

    return reduce(DataFrame.unionAll, [fitted(f) for f in frames])
