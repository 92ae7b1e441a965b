"""Bring values of both sides to one text form before hashing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from . import dates
from .types import BINARY, DATE, NESTED, NUMBER, TIMESTAMP, family_of

# Text that stands for "no value" once trimmed and upper-cased.
PSEUDO_NULLS = ["", "NULL", "NUL", "NONE", "N/A", "<NA>", "EMPTY", "NIL", "."]
# Rounding of numbers and layout of timestamps in a row hash.
DECIMALS, TIMESTAMP_LAYOUT = 3, "yyyy-MM-dd HH:mm:ss.SSS"

CONTROL_CHARS = r"[\x00-\x1F\x7F]"


def norm_text(c: Column) -> Column:
    """Upper case, trimmed, without control characters, runs of spaces collapsed.

    One look decides whether a value needs cleaning at all; most do not, and skip both
    rewrites. Once control characters are gone the only white space left is the space.
    """
    return _cleaned(F.upper(F.trim(c.cast("string"))))


def _cleaned(base: Column) -> Column:
    cleaned = F.regexp_replace(F.regexp_replace(base, CONTROL_CHARS, ""), r"\s+", " ")
    return F.when(base.rlike(CONTROL_CHARS + r"|\s\s"), cleaned).otherwise(base)


def pseudo_null(c: Column) -> Column:
    """NULL for the spellings of "no value"; meant for the output of norm_text."""
    return F.when(~c.isin(PSEUDO_NULLS), c)


def norm_label(c: Column) -> Column:
    return pseudo_null(norm_text(c))


def norm_number(c: Column, dtype: T.DataType, decimals: int = DECIMALS) -> Column:
    """``'0'`` for NULL and zero, else fixed decimals through exact decimal arithmetic.

    Values beyond 38 digits (or not finite) keep their own text instead of failing.
    """
    if isinstance(dtype, T.IntegralType):
        fixed = c.cast("string") if decimals == 0 else F.concat(c.cast("string"), F.lit("." + "0" * decimals))
    elif isinstance(dtype, T.StringType):
        # exact as far as 38 digits go; longer runs of digits keep their text, and the rest is read as a float
        exact, value = c.try_cast("decimal(38,10)"), c.try_cast("double")
        as_text, wide = norm_label(c), T.DecimalType(38, decimals)
        rounded = c.try_cast(wide)
        parsed = F.when(exact.isNotNull(), norm_number(exact, T.DecimalType(38, 10), decimals)) \
            .when(rounded.isNotNull(), norm_number(rounded, wide, decimals)) \
            .when(F.trim(c).rlike(_PLAIN_NUMBER), number_text(c, dtype)) \
            .otherwise(norm_number(value, T.DoubleType(), decimals))
        return F.when(value.isNotNull() | as_text.isNull(), parsed).otherwise(as_text)
    else:
        # 18 digits fit a machine word and cover all but outliers; both casts round half up
        fixed = F.coalesce(
            c.try_cast(f"decimal(18,{decimals})").cast("string"),
            c.try_cast(f"decimal(38,{decimals})").cast("string"),
            c.cast("string"),
        )
    return F.when(c.isNull() | (c == 0), F.lit("0")).otherwise(fixed)


_PLAIN_NUMBER = r"^[+-]?[0-9]+([.][0-9]*)?$"


def number_text(c: Column, dtype: T.DataType) -> Column:
    """A number as its digits, of any length: no plus sign, no leading zeros, no zeros behind the last decimal.

    Equal numbers have equal text whatever type they come from. Text in another notation (an exponent) is written out as
    far as 38 digits go; text that is no number stays as it is, trimmed. NULL for NULL only.
    """
    text = F.trim(c.cast("string"))
    written = F.coalesce(text.try_cast("decimal(38,10)").cast("string"), text)
    plain = text if isinstance(dtype, (T.IntegralType, T.DecimalType)) else F.when(text.rlike(_PLAIN_NUMBER), text).otherwise(written)
    whole = F.regexp_replace(plain, r"^(\+|(-))?0*(?=[0-9])", "$2") if isinstance(dtype, T.StringType) else plain
    short = F.when(plain.rlike(_PLAIN_NUMBER) & F.contains(whole, F.lit(".")), F.regexp_replace(whole, r"\.?0*$", "")).otherwise(whole)
    number = F.when(short == "-0", F.lit("0")).otherwise(short)
    return F.when(plain.rlike(_PLAIN_NUMBER), number).otherwise(plain)


def norm_date(day: Column) -> Column:
    return day.cast("string")


def norm_timestamp(c: Column) -> Column:
    return F.date_format(c, TIMESTAMP_LAYOUT)


def norm_binary(c: Column) -> Column:
    return F.hex(c)


def _told(text: Column) -> Column:
    """A part of a nested value so that no two sequences of parts read alike: its length before it, ``~`` for NULL."""
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~"))


def _told_each(values: Column, dtype: T.DataType, decimals: int) -> Column:
    """Every element of an array in canonical text, told. Lambdas share no subexpressions, so each step is bound before it is used twice."""
    if family_of(dtype) in (BINARY, DATE, NESTED, NUMBER, TIMESTAMP):
        texts = F.transform(values, lambda x: norm_nested(x, dtype, decimals))
    else:
        base = F.transform(values, lambda x: F.upper(F.trim(x.cast("string"))))
        texts = F.transform(F.transform(base, _cleaned), pseudo_null)
    return F.transform(texts, _told)


def norm_nested(c: Column, dtype: T.DataType, decimals: int = DECIMALS) -> Column:
    """Canonical text of arrays, structs and maps of any depth; every value inside is normalised by its own type.

    Array elements keep their order; fields of a struct are told by lower-case name in alphabetical order, so sides may declare
    them in any order; entries of a map are ordered by canonical key. NULL for NULL, which differs from an empty value.
    """
    if isinstance(dtype, T.ArrayType):
        return F.concat(F.lit("["), F.array_join(_told_each(c, dtype.elementType, decimals), ","), F.lit("]"))
    if isinstance(dtype, T.MapType):
        told = (_told_each(F.map_keys(c), dtype.keyType, decimals), _told_each(F.map_values(c), dtype.valueType, decimals))
        entries = F.sort_array(F.zip_with(*told, lambda k, v: F.struct(k.alias("k"), v.alias("v"))))
        return F.concat(F.lit("{"), F.array_join(F.transform(entries, lambda e: F.concat(e["k"], F.lit("="), e["v"])), ","), F.lit("}"))
    if isinstance(dtype, T.StructType):
        fields = sorted(dtype.fields, key=lambda f: f.name.lower())
        parts = [F.concat(F.lit(f.name.lower() + "="), _told(norm_nested(c.getField(f.name), f.dataType, decimals))) for f in fields]
        return F.when(c.isNotNull(), F.concat(F.lit("("), F.concat_ws(",", *parts), F.lit(")")))
    return F.when(c.isNotNull(), norm_by_type(c, dtype, decimals=decimals))


def norm_by_type(c: Column, dtype: T.DataType, family: str | None = None, fmt: str | None = None,
                 decimals: int = DECIMALS) -> Column:
    """Dispatch on the family the column pair is compared in (its own by default)."""
    family = family or family_of(dtype)
    if family == NUMBER:
        return norm_number(c, dtype, decimals)
    if family == DATE:
        return norm_date(dates.to_day(c, dtype, fmt))
    if family == TIMESTAMP:
        return norm_timestamp(c if family_of(dtype) == TIMESTAMP else c.try_cast("timestamp_ntz"))
    if family == BINARY and family_of(dtype) == BINARY:
        return norm_binary(c)
    if family == NESTED:
        return norm_nested(c, dtype, decimals)
    return norm_label(c)


def typed_value(c: Column, dtype: T.DataType, family: str, fmt: str | None = None) -> Column:
    """The raw value in the family's own type: what is profiled and what keys join on."""
    own = family_of(dtype)
    if family == NUMBER:
        if isinstance(dtype, T.IntegralType):
            return c.cast("bigint")
        return c if own == NUMBER else c.try_cast("double")
    if family == DATE:
        return dates.to_day(c, dtype, fmt)
    if family == TIMESTAMP:
        return c.cast("timestamp_ntz") if own == TIMESTAMP else c.try_cast("timestamp_ntz")
    if family == BINARY and own == BINARY:
        return F.hex(c)
    if family == NESTED:
        return norm_nested(c, dtype)
    return c.cast("string")
