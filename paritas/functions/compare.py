"""Comparers: two Columns in, a never-NULL boolean Column out."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import dates

# Absolute and relative tolerance of numeric comparisons.
ATOL, RTOL = 1e-6, 1e-6


def _settled(l: Column, r: Column, otherwise: Column) -> Column:
    """Both NULL is equal, one NULL is not, everything else is up to the comparer."""
    return (
        F.when(l.isNull() & r.isNull(), F.lit(True))
        .when(l.isNull() | r.isNull(), F.lit(False))
        .otherwise(F.coalesce(otherwise, F.lit(False)))
    )


def close(l: Column, r: Column, atol: float = ATOL, rtol: float = RTOL) -> Column:
    """Within tolerance of the right-hand value; NULL when either is not a number."""
    return (l == r) | (F.abs(l - r) <= F.lit(atol) + F.lit(rtol) * F.abs(r))


def exact(l: Column, r: Column) -> Column:
    return l.eqNullSafe(r)


def tolerance(l: Column, r: Column, atol: float = ATOL, rtol: float = RTOL) -> Column:
    return _settled(l, r, close(l.try_cast("double"), r.try_cast("double"), atol, rtol))


def exact_zero_null(l: Column, r: Column, both_ways: bool = False) -> Column:
    """Exact, and a left zero also equals a right NULL (optionally vice versa)."""
    same = l.eqNullSafe(r) | ((l == 0) & r.isNull())
    if both_ways:
        same = same | (l.isNull() & (r == 0))
    return F.coalesce(same, F.lit(False))


def _whole(c: Column) -> Column:
    """Text of digits alone as an exact number: ids and counts are equal or not, whatever their size."""
    return F.when(c.rlike(r"^[+-]?[0-9]{1,38}$"), c.try_cast("decimal(38,0)"))


def flexible(l: Column, r: Column) -> Column:
    """As dates when both are, else as numbers within tolerance, else as text."""
    l, r = l.cast("string"), r.cast("string")
    dl, dr = dates.parse_strict(l), dates.parse_strict(r)
    nl, nr = l.try_cast("double"), r.try_cast("double")
    whole_l, whole_r = _whole(l), _whole(r)
    typed = (
        F.when(dl.isNotNull() & dr.isNotNull(), dl == dr)
        .when(whole_l.isNotNull() & whole_r.isNotNull(), whole_l == whole_r)
        .when(nl.isNotNull() & nr.isNotNull(), close(nl, nr))
        .otherwise(l == r)
    )
    # equal text needs no parsing
    return _settled(l, r, F.when(l == r, F.lit(True)).otherwise(typed))


def robust(l: Column, r: Column) -> Column:
    """Zero and NULL alike both ways; numbers before dates before text."""
    l, r = l.cast("string"), r.cast("string")
    nl, nr = l.try_cast("double"), r.try_cast("double")
    dl, dr = dates.parse_strict(l), dates.parse_strict(r)
    datelike = dates.contains_datelike(l) | dates.contains_datelike(r)
    return (
        F.when(l.isNull() & r.isNull(), F.lit(True))
        .when(l.isNull(), F.coalesce(nr == 0, F.lit(False)))
        .when(r.isNull(), F.coalesce(nl == 0, F.lit(False)))
        .when(nl.isNotNull() & nr.isNotNull(), close(nl, nr))
        .when(datelike & dl.isNotNull() & dr.isNotNull(), dl == dr)
        .otherwise(l == r)
    )


def freq_list(l: Column, r: Column, item=flexible) -> Column:
    """Frequency lists ``array<struct<value, n>>`` equal entry by entry; counts of rows have no tolerance."""
    pairs = F.zip_with(l, r, lambda a, b: F.coalesce(item(a["value"], b["value"]) & (a["n"] == b["n"]), F.lit(False)))
    return _settled(l, r, (F.size(l) == F.size(r)) & F.forall(pairs, lambda x: x))


def freq_parse(raw: Column) -> Column:
    """``'v::n||v::n'`` to a list sorted by value; entries without a count are skipped."""
    entry = r"(?s)^(.*)::\s*([+-]?\d+)\s*$"
    parsed = F.transform(
        F.filter(F.split(raw, r"\|\|"), lambda e: e.rlike(entry)),
        lambda e: F.struct(
            F.regexp_extract(e, entry, 1).alias("value"),
            F.regexp_extract(e, entry, 2).try_cast("bigint").alias("n"),
        ),
    )
    return F.when(raw.isNotNull(), F.array_sort(F.filter(parsed, lambda s: s["n"].isNotNull())))


def freq_sorted(freq: Column) -> Column:
    """A frequency list re-sorted by value, so that tied counts cannot reorder it."""
    return F.array_sort(freq)


def freq_text(freq: Column) -> Column:
    """``'value(n); value(n)'`` with NULL shown as nothing."""
    return F.array_join(
        F.transform(freq, lambda s: F.concat(F.coalesce(s["value"], F.lit("")), F.lit("("), s["n"].cast("string"), F.lit(")"))),
        "; ",
    )
