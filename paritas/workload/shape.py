"""Output shaping shared by the queries, so both engines print the same values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.compare import freq_text


def steady(c: Column | str) -> Column:
    """Four decimals, shifted a little so that exact halves cannot round apart."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c + F.lit(3.7e-6), 4)


def steady_square(c: Column | str) -> Column:
    """Sums of squares: four decimals while small, rounded to ten thousands once large."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.abs(c) < 1e6, F.round(c, 4)).otherwise(F.round(c, -4))


def printed(c: Column, decimals: int) -> Column:
    """A double as a decimal the way the twins cast it: scaled as a double, and the exact digits of that product.

    The halves of the product above and below 2**40 are whole numbers of their own, so no digit is lost between them.
    """
    scaled = F.rint(c * F.lit(float(10**decimals)))
    high = F.floor(scaled / F.lit(float(1 << 40)))
    low = scaled - high.cast("double") * F.lit(float(1 << 40))
    whole = high.cast("decimal(20,0)") * F.lit(1 << 40).cast("decimal(13,0)") + low.cast("decimal(13,0)")
    exact = (whole * F.lit(f"1e-{decimals}").cast(f"decimal({decimals},{decimals})")).cast(f"decimal(38,{decimals})")
    return F.when(F.abs(scaled) < 1e30, exact).otherwise(c.cast(f"decimal(38,{decimals})"))


def big(*names: str) -> list[Column]:
    return [F.col(n).cast("bigint").alias(n) for n in names]


def text(*names: str) -> list[Column]:
    return [F.col(n).cast("string").alias(n) for n in names]


def shown_stats(stats: DataFrame, by: list[str]) -> DataFrame:
    return stats.select(
        *by, F.col("column").alias("column_name"), "kind", *big("count", "distinct", "missing"), "min", "max",
        steady("avg").alias("avg"), steady("std").alias("std"), F.round("sum", 2).alias("sum"),
        steady_square("sum_sq").alias("sum_sq"), freq_text(F.col("freq")).alias("freq"))


SHOWN_STATS_SQL = """col AS column_name, kind, CAST(cnt AS BIGINT) AS "count", CAST(dist AS BIGINT) AS "distinct",
  CAST(missing AS BIGINT) AS missing, mn AS "min", mx AS "max", round(av + 3.7e-6, 4) AS "avg",
  round(sd + 3.7e-6, 4) AS std, round(sm, 2) AS "sum",
  CASE WHEN abs(sq) < 1e6 THEN round(sq, 4) ELSE round(sq, -4) END AS sum_sq, freq"""
