"""Which columns need a profile at all: order-free fingerprints of their values first.

Equal fingerprints mean the same values, each as often, so every statistic of the column agrees. One aggregate of three sums a
column answers that for all columns; only the others are profiled, which exchanges their value frequencies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.types import NUMBER
from .columns import LEFT, RIGHT, ColumnPair

LIMB_BITS, LIMBS = 22, 3
#: Relative deviation of the estimated number of distinct values of a column that is not profiled.
ESTIMATE = 0.02


def identity(pair: ColumnPair, df: DataFrame, side: str, normalised: bool = False) -> Column:
    """The value as both sides write it alike: what the profile counts as one value."""
    column, _ = pair.source(side)
    if pair.family == NUMBER:
        floats = isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)) and pair.both_float
        return df[column].cast("double") if floats else pair.key(df, side)
    if normalised:
        return pair.normal(df, side)
    value = pair.value(df, side)
    return value.cast("date") if pair.family == "timestamp" else value


def _sums(value: Column, name: str) -> list[Column]:
    """Sums of 22-bit limbs of a 64-bit hash stay inside BIGINT for 2**41 rows; a NULL has a hash of its own."""
    digest, mask = F.xxhash64(value), F.lit((1 << LIMB_BITS) - 1)
    return [F.sum(F.shiftrightunsigned(digest, LIMB_BITS * k).bitwiseAND(mask)).alias(f"{name}_{k}") for k in range(LIMBS)]


def value_prints(df: DataFrame, pairs: list[ColumnPair], side: str, by: list[str], normalised: bool = False) -> DataFrame:
    """``(by..., column, n, limbs)``; a task hands on one row for each group."""
    told = df.select(*by, *[identity(p, df, side, normalised).alias(f"v_{i}") for i, p in enumerate(pairs)])
    sums = [s for i in range(len(pairs)) for s in _sums(F.col(f"v_{i}"), f"s_{i}")]
    summed = told.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *sums)
    rows = F.array(*[F.struct(F.lit(p.name).alias("column"), F.array(*[F.col(f"s_{i}_{k}") for k in range(LIMBS)]).alias("limbs")) for i, p in enumerate(pairs)])
    return summed.select(*by, "n", F.inline(rows)).select(*by, "column", "n", "limbs")


def gate(left: DataFrame, right: DataFrame, pairs: list[ColumnPair], by: list[str], normalised: bool = False) -> DataFrame:
    """``(by..., column, is_equal)``; a group on one side only is not equal."""
    sides = [value_prints(df, pairs, side, by, normalised).withColumn("side", F.lit(side)) for df, side in ((left, LEFT), (right, RIGHT))]
    pick = lambda side: F.first(F.when(F.col("side") == side, F.struct("n", "limbs")), ignorenulls=True)
    return sides[0].unionByName(sides[1]).groupBy(*by, "column").agg(
        F.coalesce(pick(LEFT) == pick(RIGHT), F.lit(False)).alias("is_equal"))


def estimated_distinct(df: DataFrame, pairs: list[ColumnPair], side: str, by: list[str]) -> DataFrame:
    """``(column, max_distinct)``: about the most distinct values of a column in any group, from sketches that merge."""
    told = df.select(*by, *[identity(p, df, side).alias(f"v_{i}") for i, p in enumerate(pairs)])
    counted = told.groupBy(*by).agg(*[F.approx_count_distinct(f"v_{i}", ESTIMATE).alias(f"d_{i}") for i in range(len(pairs))])
    most = counted.agg(*[F.max(f"d_{i}").alias(f"d_{i}") for i in range(len(pairs))])
    return most.select(F.inline(F.array(*[F.struct(F.lit(p.name).alias("column"), F.col(f"d_{i}").alias("max_distinct")) for i, p in enumerate(pairs)])))
