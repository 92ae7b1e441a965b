"""Type families: how a data type is profiled, normalised and compared."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

NUMBER, TEXT, DATE, TIMESTAMP, BINARY, NESTED = "number", "text", "date", "timestamp", "binary", "nested"

# Which right-hand type names a left-hand family may map to.
COMPATIBLE_RIGHT_TYPES = {
    NUMBER: r"double|decimal|int",
    TEXT: r"string|char",
    DATE: r"date|timestamp",
    TIMESTAMP: r"timestamp",
    NESTED: r"array|map|struct",
}

# Type names, as written by the common warehouses, per family.
FAMILY_PATTERNS = [
    (NUMBER, r"^(number|numeric|decimal|double|float|real|binary_float|binary_double"
             r"|(tiny|small|big)?int(eger)?|byte|short|long)\b"),
    (TIMESTAMP, r"^timestamp"),
    (DATE, r"^date\b"),
    (TEXT, r"^(n?(var)?char2?|string|text|clob)\b"),
    (BINARY, r"^(raw|binary|varbinary|blob)\b"),
    (NESTED, r"^(array|map|struct)\b"),
]


def family_of(dtype: T.DataType) -> str:
    """Family of a Spark type; anything unknown is handled as text."""
    if isinstance(dtype, T.NumericType):
        return NUMBER
    if isinstance(dtype, T.DateType):
        return DATE
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return TIMESTAMP
    if isinstance(dtype, T.BinaryType):
        return BINARY
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return NESTED
    return TEXT


def common_family(left: T.DataType, right: T.DataType) -> str:
    """The coarser family two mapped columns can both be brought to.

    A date meeting a timestamp is compared as a date, a text column that mirrors a
    typed one is parsed into that type.
    """
    pair = {family_of(left), family_of(right)}
    if len(pair) == 1:
        return pair.pop()
    if pair == {DATE, TIMESTAMP}:
        return DATE
    for typed in (DATE, TIMESTAMP, NUMBER):
        if pair == {typed, TEXT}:
            return typed
    return TEXT


def family_of_name(type_name: Column) -> Column:
    """Family of a type *name* column, as found in a foreign catalog."""
    name = F.lower(F.trim(type_name))
    out = F.lit(None).cast("string")
    for family, pattern in reversed(FAMILY_PATTERNS):
        out = F.when(name.rlike(pattern), F.lit(family)).otherwise(out)
    return out


def is_numeric_name(type_name: Column) -> Column:
    """True for type names that get the continuous profile."""
    return F.coalesce(family_of_name(type_name) == NUMBER, F.lit(False))


def types_compatible(left_type: Column, right_type: Column) -> Column:
    """May a left column of this type be mapped to a right column of that type?"""
    family, right = family_of_name(left_type), F.lower(right_type)
    out = F.lit(False)
    for name, pattern in COMPATIBLE_RIGHT_TYPES.items():
        out = F.when(family == name, right.rlike(pattern)).otherwise(out)
    return F.coalesce(out, F.lit(False))
