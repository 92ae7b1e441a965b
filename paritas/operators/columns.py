"""A mapped column pair and the expressions each side contributes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import normalize
from ..functions.dates import ISO_TIME
from ..functions.types import NUMBER, TIMESTAMP, common_family

LEFT, RIGHT = "left", "right"


@dataclass(frozen=True)
class ColumnPair:
    """One left column, the right column it is mapped to, and how they are compared.

    ``left_fmt`` / ``right_fmt`` are the date patterns of text columns, if any. ``key_type`` is the exact type in which
    numbers of both sides meet as keys, or DIGITS where none holds both.
    """

    left: str
    right: str
    family: str
    left_fmt: str | None = None
    right_fmt: str | None = None
    key_type: str = "bigint"
    both_float: bool = False

    @property
    def name(self) -> str:
        """Results carry the left name."""
        return self.left

    def source(self, side: str) -> tuple[str, str | None]:
        return (self.left, self.left_fmt) if side == LEFT else (self.right, self.right_fmt)

    @property
    def whole_seconds(self) -> bool:
        """A timestamp whose partner is text without fractions is compared by the second."""
        return self.family == TIMESTAMP and ISO_TIME in (self.left_fmt, self.right_fmt)

    def value(self, df: DataFrame, side: str) -> Column:
        """Raw value in the pair's common type."""
        column, fmt = self.source(side)
        value = normalize.typed_value(df[column], df.schema[column].dataType, self.family, fmt)
        return F.date_trunc("second", value).cast("timestamp_ntz") if self.whole_seconds else value

    def normal(self, df: DataFrame, side: str, decimals: int = normalize.DECIMALS) -> Column:
        """Normalised text of the value."""
        if self.whole_seconds:
            return normalize.norm_timestamp(self.value(df, side))
        column, fmt = self.source(side)
        return normalize.norm_by_type(df[column], df.schema[column].dataType, self.family, fmt, decimals)

    def key(self, df: DataFrame, side: str) -> Column:
        """Value as a join key: numbers in the exact type that holds both sides, or as their digits. NULL for NULL only."""
        column, _ = self.source(side)
        if self.family != NUMBER:
            return self.value(df, side)
        if self.key_type == DIGITS:
            return normalize.number_text(df[column], df.schema[column].dataType)
        return df[column].cast(self.key_type)


#: Key type of numbers that no one type holds exactly: text or floats on a side, or too many digits.
DIGITS = "digits"
_LONG_DIGITS, _MOST_DIGITS = 19, 38


def exact_type(left: T.DataType, right: T.DataType) -> str:
    """BIGINT for whole numbers, a decimal that holds the digits of both sides if there is one, else DIGITS."""
    if isinstance(left, T.IntegralType) and isinstance(right, T.IntegralType):
        return "bigint"
    if not all(isinstance(t, (T.IntegralType, T.DecimalType)) for t in (left, right)):
        return DIGITS
    whole = max(t.precision - t.scale if isinstance(t, T.DecimalType) else _LONG_DIGITS for t in (left, right))
    scale = max(t.scale if isinstance(t, T.DecimalType) else 0 for t in (left, right))
    return f"decimal({_MOST_DIGITS},{scale})" if whole + scale <= _MOST_DIGITS else DIGITS


def pair_columns(left: DataFrame, right: DataFrame, mapping: dict[str, str],
                 left_fmt: dict[str, str] | None = None,
                 right_fmt: dict[str, str] | None = None) -> list[ColumnPair]:
    """Column pairs of a left→right mapping, typed from both schemas.

    Formats are keyed by the column name of their own side.
    """
    left_fmt, right_fmt = left_fmt or {}, right_fmt or {}
    return [
        ColumnPair(l, r, common_family(left.schema[l].dataType, right.schema[r].dataType),
                   left_fmt.get(l), right_fmt.get(r), exact_type(left.schema[l].dataType, right.schema[r].dataType),
                   all(isinstance(t, (T.DoubleType, T.FloatType)) for t in (left.schema[l].dataType, right.schema[r].dataType)))
        for l, r in mapping.items()
    ]


def same_columns(df: DataFrame, columns: list[str]) -> list[ColumnPair]:
    """Pairs of a table with itself, for one-sided operators."""
    return pair_columns(df, df, {c: c for c in columns})
