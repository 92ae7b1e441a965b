"""Sums, sums of squares and deviations of doubles that do not depend on the order of the rows.

A double is an integer times a power of two. Values are grouped by binary magnitude (``SPAN`` bits a group); within a group each
is an integer below 2**75, cut into three parts of ``PART`` bits, and its square into six. Parts are added as BIGINT, which is
exact for 2**35 rows a group, whatever the partitioning. The few sums of a column are put together in one fixed
order, in pairs of doubles (about 106 bits), so the spread is right also where it is small against the mean.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SPAN, PART, LOWEST = 20, 25, -48
SUMS, SQUARES = 3, 6
#: Splits a double into two halves whose products are exact.
_SPLITTER = float((1 << 27) + 1)


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def magnitude(x: Column) -> Column:
    """The group of a finite number; 0 for zero, NULL for what is not finite."""
    group = F.greatest(F.floor(F.log2(F.abs(x)) / SPAN), F.lit(LOWEST)).cast("int")
    return F.when(finite(x), F.when(x == 0, F.lit(0)).otherwise(group))


def part_columns(x: Column, group: Column) -> dict[str, Column]:
    """The parts of each value and of its square, NULL for what is not finite."""
    scaled = F.abs(x) * F.pow(F.lit(2.0), F.lit(54) - SPAN * group)
    unit = float(1 << PART)
    top = F.floor(scaled / (unit * unit))
    rest = scaled - top * (unit * unit)
    middle = F.floor(rest / unit)
    a, b, c = top, middle, F.floor(rest - middle * unit)
    signed = lambda v: F.when(x < 0, -v).otherwise(v)
    terms = [c * c, 2 * b * c, b * b + 2 * a * c, 2 * a * b, a * a]
    low, high = (lambda t: t.bitwiseAND(F.lit((1 << PART) - 1))), (lambda t: F.shiftright(t, PART))
    squares = [low(terms[0]), *[high(terms[k - 1]) + low(terms[k]) for k in range(1, 5)], high(terms[4])]
    return {**{f"m_{k}": signed(v) for k, v in enumerate((c, b, a))}, **{f"q_{k}": v for k, v in enumerate(squares)}}


def part_sums() -> list[Column]:
    return [F.sum(name).alias(name) for name in [*(f"m_{k}" for k in range(SUMS)), *(f"q_{k}" for k in range(SQUARES))]]


def scale(groups: Column) -> Column:
    """Binary exponent of the greatest group; totals are kept below it, so that squares of large values do not overflow."""
    return F.coalesce(F.get(groups, F.lit(0))["magnitude"] * SPAN, F.lit(0))


def _terms(groups: Column, exponent: Column, prefix: str, n: int, powers: int) -> Column:
    """Doubles that add up to the scaled total, the greatest groups and parts first; a sum goes in as two exact halves."""
    def of(g: Column) -> Column:
        parts = []
        for k in reversed(range(n)):
            weight = F.pow(F.lit(2.0), PART * k + powers * (SPAN * g["magnitude"] - 54 - exponent))
            value = g[f"{prefix}_{k}"]
            parts += [F.shiftright(value, 32).cast("double") * F.lit(float(1 << 32)) * weight, value.bitwiseAND(F.lit((1 << 32) - 1)).cast("double") * weight]
        return F.array(*parts)

    return F.flatten(F.transform(groups, of))


def _pair(hi: Column, lo: Column) -> Column:
    return F.struct(hi.alias("hi"), lo.alias("lo"))


def _added(acc: Column, term: Column) -> Column:
    total = acc["hi"] + term
    back = total - acc["hi"]
    low = acc["lo"] + (acc["hi"] - (total - back)) + (term - back)
    return _pair(total + low, low - (total + low - total))


def total(groups: Column, exponent: Column, prefix: str, n: int, powers: int) -> Column:
    """``(hi, lo)`` of a sum of first or second ``powers``, over two to the exponent as often, from its groups in their order."""
    return F.aggregate(_terms(groups, exponent, prefix, n, powers), _pair(F.lit(0.0), F.lit(0.0)), _added)


def _product(x: Column, y: Column) -> tuple[Column, Column]:
    """A product and what its rounding leaves."""
    half = lambda v: v * _SPLITTER - (v * _SPLITTER - v)
    xh, yh, p = half(x), half(y), x * y
    xl, yl = x - xh, y - yh
    return p, ((xh * yh - p) + xh * yl + xl * yh) + xl * yl


def deviation(n: Column, s: Column, q: Column) -> Column:
    """Standard deviation of a sample from its size and the pairs of its scaled sum and sum of squares, scaled alike; NULL for one value."""
    n = n.cast("double")
    nq, nq_rest = _product(q["hi"], n)
    ss, ss_rest = _product(s["hi"], s["hi"])
    spread = (nq - ss) + ((nq_rest + q["lo"] * n) - (ss_rest + 2 * s["hi"] * s["lo"]))
    return F.when(n > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (n * (n - 1))))
